"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, h1 string, label int, n long"


def words_of(text):
    return WORD.findall(text or "")


def sentence(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def edge_rows(seed=1, copies=6):
    """Null, empty and white-space texts, one word, a very long text, repeated
    rows, a null key, exact and near copies, shared lines and passages."""
    rng = random.Random(seed)
    base, passage, line = sentence(rng, 60), sentence(rng, 40), "  The SAME line\t"
    rows = [(1, None), (2, ""), (3, " \n\t \x0b"), (4, "one"), (5, "A b c d"), (6, "a B c d"),
            (7, sentence(rng, 20_000, 50)), (8, base), (8, base), (None, base), (None, None), (9, "x " * 3000)]
    for i in range(copies):
        near = base.split()
        near[5 + 3 * i] = f"changed{i}"
        rows.append((20 + i, " ".join(near)))
        rows.append((40 + i, base))
        rows.append((60 + i, sentence(rng, 30) + "\n" + line + "\n" + passage + " é ß\n\n" + sentence(rng, 25)))
        rows.append((80 + i, line.strip().upper() + "\r\n" + sentence(rng, 8)))
    rng.shuffle(rows)
    return [(k, t, rng.choice(["en", "fr", None]), "src0", len(t or ""), -1, "h", 5, 7) for k, t in rows]


def edge_docs(spark, **kw):
    return spark.createDataFrame(edge_rows(**kw), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
