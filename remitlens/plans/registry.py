"""Query registry: name → (Spark builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame; each
oracle is an independent SQL statement over the raw driver tables, prefixed
with the shared model CTEs (users, accounts, tx, etx, geo, fact).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}

# The provinces of nations 0 to 23 (nation 24 has none), as written and normalised.
PROVINCES_SQL = """['Hà Nội', 'Hải Phòng', 'Bắc Ninh', 'Hà Nam', 'Hải Dương', 'Hưng Yên', 'Nam Định', 'Ninh Bình',
  'Thái Bình', 'Vĩnh Phúc', 'Thanh Hóa', 'Nghệ An', 'Hà Tĩnh', 'Quảng Bình', 'Quảng Trị', 'Thừa Thiên Huế', 'Đà Nẵng',
  'Quảng Nam', 'Hồ Chí Minh', 'Cần Thơ', 'An Giang', 'Bến Tre', 'Cà Mau', 'Long An']"""
NORMALISED_SQL = """['HaNoi', 'HaiPhong', 'BacNinh', 'HaNam', 'HaiDuong', 'HungYen', 'NamDinh', 'NinhBinh',
  'ThaiBinh', 'VinhPhuc', 'ThanhHoa', 'NgheAn', 'HaTinh', 'QuangBinh', 'QuangTri', 'ThuaThienHue', 'DaNang',
  'QuangNam', 'HoChiMinh', 'CanTho', 'AnGiang', 'BenTre', 'CaMau', 'LongAn']"""

# The driver-table → transfer-model mapping, as DuckDB SQL (mirrors
# remitlens.sources.model and remitlens.operators.facts).
MODEL_CTES = """WITH users AS (
  SELECT c_custkey AS user_id, c_name AS full_name, CAST(100000000000 + c_custkey AS VARCHAR) AS account_number,
         c_acctbal AS balance, (@RAW@)[c_nationkey + 1] AS province, c_mktsegment AS district, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
accounts AS (
  SELECT c_custkey AS account_id, c_custkey AS user_id, CAST(100000000000 + c_custkey AS VARCHAR) AS account_number,
         CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
         CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status
  FROM customer),
tx AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS from_id,
         (o_custkey + o_orderkey * 7) % (SELECT count(*) FROM customer) AS to_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'O' THEN 'PENDING'
              WHEN o_orderpriority = '1-URGENT' THEN 'REVERSED' WHEN o_orderpriority = '2-HIGH' THEN 'COMPLETED'
              ELSE 'FAILED' END AS status,
         o_orderdate AS created_at
  FROM orders),
etx AS (
  SELECT event_id AS transaction_id, user_id AS from_id,
         (user_id + 1 + event_id % 7) % (SELECT max(user_id) + 1 FROM events) AS to_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'click' THEN 'SUCCESS' WHEN 'view' THEN 'COMPLETED'
              WHEN 'signup' THEN 'PENDING'
              ELSE CASE WHEN event_id % 3 = 0 THEN 'REVERSED' ELSE 'FAILED' END END AS status,
         ts AS created_at
  FROM events),
geo AS (
  SELECT e.transaction_id, e.from_id, e.to_id, e.amount, e.status, e.created_at,
         u.user_id AS from_user_id, u.account_number AS from_account, u.full_name AS from_name,
         u.province AS from_province, u.district AS from_district,
         v.user_id AS to_user_id, v.account_number AS to_account, v.full_name AS to_name,
         v.province AS to_province, v.district AS to_district
  FROM etx e JOIN users u ON u.user_id = e.from_id JOIN users v ON v.user_id = e.to_id),
fact AS (
  SELECT transaction_id, from_user_id AS owner_user_id, from_account AS owner_account_id, 'OUT' AS direction,
         to_account AS counterparty_account_id, amount, status, created_at,
         coalesce((@NORM@)[list_position(@RAW@, from_province)], 'Unknown') AS province,
         upper(from_district[1]) || lower(from_district[2:]) AS district,
         year(created_at) AS year, 'Q' || quarter(created_at) AS quarter, strftime(created_at, '%Y-%m') AS month
  FROM geo
  UNION ALL
  SELECT transaction_id, to_user_id, to_account, 'IN', from_account, amount, status, created_at,
         coalesce((@NORM@)[list_position(@RAW@, to_province)], 'Unknown'),
         upper(to_district[1]) || lower(to_district[2:]),
         year(created_at), 'Q' || quarter(created_at), strftime(created_at, '%Y-%m')
  FROM geo)""".replace("@RAW@", PROVINCES_SQL).replace("@NORM@", NORMALISED_SQL)


def register(name: str, oracle: str | None = None, recursive: bool = False):
    """Register a query builder; ``oracle`` is SQL over the model CTEs.

    An oracle starting with ',' adds further CTEs before its final SELECT.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            body = oracle.strip()
            ctes = MODEL_CTES.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else MODEL_CTES
            _ORACLES[name] = ctes + "\n" + body
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    from remitlens.plans import catalog  # noqa: F401  (registers on import)
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    from remitlens.plans import catalog  # noqa: F401
    return dict(_ORACLES)
