from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.functions import casts, messages, predicates, text, variant
from pactloom.parity import inputs
from pactloom.parity.case import Case
from pactloom.parity.inputs import AS_OF


def _over(table: str, columns: Callable[[], dict[str, Column]]):
    """A query that computes the named columns for every row of a table."""
    return lambda spark, sf_dir: inputs.table(spark, sf_dir, table).select(
        *[c.alias(n) for n, c in columns().items()]
    )


def _strings(name: str) -> Column:
    return F.col(name).cast("string")


def _mixed() -> Column:
    """A text column with every kind of value the casts meet."""
    key = F.col("o_orderkey")
    padded = F.concat(F.lit(" "), _strings("o_orderkey"), F.lit(" "))
    return F.when(key % 3 == 0, padded).when(key % 3 == 1, F.concat(F.lit("n"), _strings("o_orderkey"))).otherwise("")


def _flag() -> Column:
    state = F.col("o_orderstatus")
    return F.when(state == "F", "TRUE").when(state == "O", " false ").otherwise("yes")


def _day() -> Column:
    day = _strings("o_orderdate")
    return F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(F.concat(F.lit("day "), day))


def _now() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        casts.safe_cast(_mixed(), "INT64").alias("as_int64"),
        casts.safe_cast(money, "NUMERIC").alias("as_numeric"),
        casts.safe_cast(money, "FLOAT64").alias("as_float64"),
        casts.safe_cast(_flag(), "BOOL").alias("as_bool"),
        casts.safe_cast(_day(), "DATE").alias("as_date"),
        casts.safe_cast(_day(), "TIMESTAMP").alias("as_timestamp"),
        casts.safe_cast(_mixed(), "STRING").alias("as_string"),
    )


_MIXED_SQL = """CASE WHEN o_orderkey % 3 = 0 THEN concat(' ', CAST(o_orderkey AS VARCHAR), ' ')
  WHEN o_orderkey % 3 = 1 THEN concat('n', CAST(o_orderkey AS VARCHAR)) ELSE '' END"""
_DAY_SQL = "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS VARCHAR) ELSE concat('day ', CAST(o_orderdate AS VARCHAR)) END"

def _ref() -> Column:
    key = F.col("o_orderkey")
    place = F.when(key % 3 == 0, "proj.sales.").when(key % 3 == 1, "sales.").otherwise("")
    return F.concat(place, F.when(key % 2 == 0, "a_raw_b").otherwise("t"), F.lit("_raw"))


_REF_SQL = """concat(CASE o_orderkey % 3 WHEN 0 THEN 'proj.sales.' WHEN 1 THEN 'sales.' ELSE '' END,
  CASE o_orderkey % 2 WHEN 0 THEN 'a_raw_b' ELSE 't' END, '_raw')"""

def _email() -> Column:
    name = F.lower(F.translate("c_name", "#", "_"))
    return F.concat(F.lit("accounts:"), name, F.lit("."), F.col("c_mktsegment"), F.lit("@example.com"))


def _fenced() -> Column:
    kind = F.col("doc_id") % 3
    block = F.concat(F.lit("```sql\n"), "text", F.lit("\n```"))
    line = F.concat(F.lit("```sql select "), F.col("doc_id"), F.lit("```"))
    return F.when(kind == 0, block).when(kind == 1, line).otherwise(F.col("text"))


_FENCED_SQL = """CASE doc_id % 3 WHEN 0 THEN concat('```sql', chr(10), text, chr(10), '```')
  WHEN 1 THEN concat('```sql select ', CAST(doc_id AS VARCHAR), '```') ELSE text END"""

def _blanks() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "view", " NaN ").when(kind == "click", "  ").otherwise(F.concat(F.lit(" "), kind, F.lit(" ")))


def _bytes() -> Column:
    return F.col("l_orderkey") * 1000000000 + F.col("l_linenumber")


def _new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", text.new_id().alias("id"))


def _row_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.to_json(F.struct("n_nationkey", "n_name", "c_custkey", "c_name"))
    nations = inputs.table(spark, sf_dir, "nation")
    customers = inputs.table(spark, sf_dir, "customer")
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    return joined.select("c_custkey", row.alias("payload"))


_SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

CASES = [
    Case("fn_safe_cast", _safe_cast, f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN TRY_CAST(trim({_MIXED_SQL}) AS BIGINT) END AS as_int64,
        TRY_CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DECIMAL(38,9)) AS as_numeric,
        TRY_CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS as_float64,
        CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS as_bool,
        CAST(TRY_CAST({_DAY_SQL} AS TIMESTAMP) AS DATE) AS as_date, TRY_CAST({_DAY_SQL} AS TIMESTAMP) AS as_timestamp,
        {_MIXED_SQL} AS as_string FROM orders"""),
    Case("fn_cast_string", _over("lineitem", lambda: dict(order_text=_strings("l_orderkey"), line_text=_strings("l_linenumber"),
            ship_text=F.col("l_shipdate").cast("date").cast("string"))),
        "SELECT CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_linenumber AS VARCHAR) AS line_text, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_text FROM lineitem"),
    Case("fn_coalesce", lambda spark, sf_dir: inputs.orders_raw(spark, sf_dir).select(
            F.coalesce("customer_name", F.lit("")).alias("name"), "order_id", "processed_dttm"),
        inputs.WITH_RAW + "SELECT COALESCE(customer_name, '') AS name, order_id, processed_dttm FROM orders_raw"),
    Case("fn_norm_blank", _over("events", lambda: dict(event_id=F.col("event_id"), kept=text.norm_blank(_blanks()))),
        "SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click') THEN event_type END AS kept FROM events"),
    Case("fn_current", _over("orders", lambda: dict(o_orderkey=F.col("o_orderkey"), today=_now().cast("date"), moment=_now(),
            age=F.date_diff(_now().cast("date"), F.col("o_orderdate").cast("date")).cast("bigint"))),
        f"SELECT o_orderkey, DATE '{AS_OF[:10]}' AS today, TIMESTAMP '{AS_OF}' AS moment, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF[:10]}') AS age FROM orders"),
    Case("fn_interval", _over("events", lambda: dict(event_id=F.col("event_id"),
            recent=F.col("ts").cast("timestamp") >= F.lit("2024-01-20 00:00:00").cast("timestamp") - F.expr("INTERVAL 24 HOURS"))),
        "SELECT event_id, ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOUR AS recent FROM events"),
    Case("fn_date_format", _over("events", lambda: dict(event_id=F.col("event_id"), stamp=text.compact_timestamp(F.col("ts")))),
        "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events"),
    Case("fn_parse_temporal", _over("orders", lambda: dict(o_orderkey=F.col("o_orderkey"),
            day=casts.safe_parse_date(F.when(F.col("o_orderkey") % 7 == 0, "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))),
            moment=casts.safe_parse_timestamp(F.when(F.col("o_orderkey") % 5 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))))),
        """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS moment FROM orders"""),
    Case("fn_lower_regexp", _over("part", lambda: dict(p_partkey=F.col("p_partkey"), low=F.lower("p_type"),
            found=predicates.matches(F.lower("p_type"), "brass|steel"), starts=predicates.matches(F.col("p_brand"), "^Brand#[1-3]"))),
        "SELECT p_partkey, lower(p_type) AS low, regexp_matches(lower(p_type), 'brass|steel') AS found, regexp_matches(p_brand, '^Brand#[1-3]') AS starts FROM part"),
    Case("fn_truncate_error", _over("documents", lambda: dict(doc_id=F.col("doc_id"), error=text.truncate_error(F.col("text")))),
        "SELECT doc_id, CASE WHEN text <> '' THEN substring(text, 1, 2000) END AS error FROM documents"),
    Case("fn_basename_extension", _over("pages", lambda: dict(page_id=F.col("page_id"), base=text.basename(F.col("url")), ext=text.extension(F.col("url")))),
        r"SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, lower(regexp_extract(url, '(?:^|/)\.*[^./][^/]*\.([^./]*)$', 1)) AS ext FROM pages"),
    Case("fn_table_ref", _over("orders", lambda: dict(o_orderkey=F.col("o_orderkey"), dataset=text.table_dataset(_ref()), name=text.table_name(_ref()),
            base=text.table_base_name(_ref()), is_raw=text.is_raw_table(_ref()))),
        f"""SELECT o_orderkey, CASE WHEN contains(ref, '.') THEN string_split(ref, '.')[-2] ELSE 'raw' END AS dataset, string_split(ref, '.')[-1] AS name,
           replace(string_split(ref, '.')[-1], '_raw', '') AS base, ends_with(ref, '_raw') AS is_raw FROM (SELECT o_orderkey, {_REF_SQL} AS ref FROM orders) t"""),
    Case("fn_collapse_whitespace", _over("documents", lambda: dict(doc_id=F.col("doc_id"), flat=text.collapse_whitespace(F.col("text")))),
        f"SELECT doc_id, coalesce(trim(regexp_replace(text, '{_SPACES}', ' ', 'g')), '') AS flat FROM documents"),
    Case("fn_strip_fence", _over("documents", lambda: dict(doc_id=F.col("doc_id"), body=text.strip_code_fence(_fenced()))),
        f"""SELECT doc_id, CASE WHEN NOT starts_with(t, '```') THEN t
           WHEN NOT contains(t, chr(10)) THEN replace(replace(t, '```sql', ''), '```', '')
           ELSE regexp_replace(regexp_replace(t, '^[^\\n]*\\n', ''), '\\n[^\\n]*$', '') END AS body FROM (SELECT doc_id, {_FENCED_SQL} AS t FROM documents) d"""),
    Case("fn_display_name", _over("customer", lambda: dict(c_custkey=F.col("c_custkey"), shown=text.display_name(_email()))),
        """SELECT c_custkey, array_to_string(list_transform(string_split(translate(concat(lower(replace(c_name, '#', '_')), '.', c_mktsegment), '._', '  '), ' '),
           lambda w: upper(w[1]) || lower(w[2:])), ' ') AS shown FROM customer"""),
    Case("fn_format_number", _over("lineitem", lambda: dict(l_orderkey=F.col("l_orderkey"), l_linenumber=F.col("l_linenumber"),
            grouped=text.thousands(_bytes()), priced=text.money(F.col("l_discount")))),
        """SELECT l_orderkey, l_linenumber, format('{:,}', l_orderkey * 1000000000 + l_linenumber) AS grouped,
           printf('%.4f', l_discount) AS priced FROM lineitem"""),
    Case("fn_scan_cost", _over("lineitem", lambda: dict(l_orderkey=F.col("l_orderkey"), l_linenumber=F.col("l_linenumber"), cost=F.round(text.scan_cost(_bytes()), 6))),
        "SELECT l_orderkey, l_linenumber, round(CAST(l_orderkey * 1000000000 + l_linenumber AS DOUBLE) / 1099511627776.0::DOUBLE * 6.25::DOUBLE, 6) AS cost FROM lineitem"),
    Case("fn_good_count", _over("events", lambda: dict(event_id=F.col("event_id"), good=F.col("user_id") - F.col("user_id") % 3)),
        "SELECT event_id, user_id - user_id % 3 AS good FROM events"),
    Case("fn_new_id", _new_ids),
    Case("fn_to_json", _row_json, """SELECT c_custkey, concat('{"n_nationkey":', CAST(n_nationkey AS VARCHAR), ',"n_name":"', n_name, '","c_custkey":',
        CAST(c_custkey AS VARCHAR), ',"c_name":"', c_name, '"}') AS payload FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    Case("fn_json_path", _over("events", lambda: dict(event_id=F.col("event_id"), k=F.get_json_object("props", "$.k"),
            fallback=F.coalesce(F.get_json_object("props", "$.protoPayload.status.message"), F.get_json_object("props", "$.k"), F.lit("none")))),
        """SELECT event_id, json_extract_string(props, '$.k') AS k,
           coalesce(json_extract_string(props, '$.protoPayload.status.message'), json_extract_string(props, '$.k'), 'none') AS fallback FROM events"""),
    Case("fn_variant_path", lambda spark, sf_dir: variant.variant_fields(
            inputs.table(spark, sf_dir, "events").select("event_id", variant.as_variant("props").alias("v")), "v",
            {"k": ("$.k", "bigint"), "as_text": ("$.k", "string"), "absent": ("$.a.b", "bigint")}).drop("v"),
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS as_text, CAST(NULL AS BIGINT) AS absent FROM events"),
    Case("fn_json_keys", _over("events", lambda: dict(event_id=F.col("event_id"), names=F.array_join(F.json_object_keys("props"), ","), has_k=messages.has_key(F.col("props"), "k"))),
        "SELECT event_id, array_to_string(json_keys(props), ',') AS names, list_contains(json_keys(props), 'k') AS has_k FROM events"),
    Case("fn_first_sample_keys", _over("events", lambda: dict(event_id=F.col("event_id"), names=F.array_join(messages.first_sample_keys(
            F.from_json(F.concat(F.lit("["), "props", F.lit("]")), "array<map<string,string>>")), ","))),
        "SELECT event_id, array_to_string(json_keys(props), ',') AS names FROM events"),
    Case("fn_base64", _over("documents", lambda: dict(doc_id=F.col("doc_id"), same=messages.decode_base64(messages.encode_base64(F.col("text"))),
            coded=F.replace(messages.encode_base64(F.col("text")), F.lit("\r\n"), F.lit("")))),
        "SELECT doc_id, decode(from_base64(to_base64(encode(text)))) AS same, to_base64(encode(text)) AS coded FROM documents"),
]
