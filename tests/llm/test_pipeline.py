import pytest

import __spark_entry__ as entry
import corpus_pipeline
from remitlens.llm import catalog
from tests.conftest import SF_SMALL
from tests.llm.data import SCHEMA, edge_docs


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = edge_docs(spark)
    spark.createDataFrame([(8, 1, 0), (60, 0, 1), (61, 1, 0), (62, 1, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        read = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert read.columns == docs.columns and 0 < read.count() <= docs.count()
            assert read.where("text is not null and n_chars <> char_length(text)").count() == 0
        docs = read
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_run_and_registration(spark):
    queries = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in queries) for n in range(1, 14)] == [1] * 13
    assert queries["pipeline"] is corpus_pipeline.run and set(catalog.ORACLES) <= set(queries)
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 50 and "sequence_id" in out.columns


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries_return_their_columns(spark, name):
    want = {
        1: "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
        2: "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
        3: "query_id bigint, rank int, vec_id bigint, score double",
        4: "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        5: "doc_id bigint, n_shingles bigint, component_id bigint",
        6: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        7: "doc_id bigint, lang string, n_bytes bigint, log_prob double, perplexity double, threshold double, keep boolean",
        8: "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double",
        9: "doc_id bigint, held_out boolean, score double, predicted int",
        10: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        11: "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, "
            "restored_sha256 string",
        12: "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
            "saved_tokens bigint, ends_sha256 string",
        13: "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    }[int(name[2:].split("_")[0])]
    assert ", ".join(" ".join(t) for t in catalog.QUERIES[name](spark, SF_SMALL).dtypes) == want
