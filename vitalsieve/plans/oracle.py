"""The same results in plain SQL over the whole tables, written independently of the Spark plans."""

from __future__ import annotations

from vitalsieve import contracts
from vitalsieve.operators import routing
from vitalsieve.plans.requests import BODY, INTERCEPT, WEIGHTS, grouped_body, mixed_body, mixed_served, request_number, NESTED

ORACLE: dict[str, str] = {}

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _profile(table: str, columns: list[tuple[str, str, bool]], target: str | None = None) -> str:
    parts = []
    r4 = lambda expr: r(expr, 4)
    for name, dtype, numeric in columns:
        num = (lambda f: f) if numeric else (lambda f: "NULL::DOUBLE")
        x = f"{name}::DOUBLE" if numeric else name
        parts.append(f"""
SELECT '{name}' AS feature, '{dtype}' AS dtype, {'TRUE' if name == target else 'FALSE'} AS is_target,
  count(DISTINCT {name})::BIGINT AS n_distinct, count(*) FILTER (WHERE {name} IS NULL)::BIGINT AS missing,
  {r4(f'count(*) FILTER (WHERE {name} IS NULL) * 100.0 / count(*)')}::DOUBLE AS missing_pct,
  {f'count(*) FILTER (WHERE {name} = 0)::BIGINT' if numeric else 'NULL::BIGINT'} AS zeros,
  {r4(f'count(*) FILTER (WHERE {name} = 0) * 100.0 / count(*)') + '::DOUBLE' if numeric else 'NULL::DOUBLE'} AS zero_pct,
  {num(r4(f'min({x})'))} AS min, {num(r4(f'avg({x})'))} AS mean, {num(r4(f'quantile_cont({x}, 0.5)'))} AS median,
  {num(r4(f'stddev_samp({x})'))} AS std, {num(r4(f'max({x})'))} AS max
FROM {table}""")
    return union(parts)


_LINE = [(k, "bigint", True) for k in ("l_orderkey", "l_partkey", "l_suppkey")] + [(m, "double", True) for m in MEASURES] + [
    ("l_linenumber", "int", True), ("l_returnflag", "string", False), ("l_linestatus", "string", False), ("l_shipdate", "timestamp_ntz", False)]
ORACLE["column_profile"] = _profile("lineitem", _LINE, "l_returnflag")
ORACLE["column_profile_customer"] = _profile(
    "customer", [("c_custkey", "bigint", True), ("c_name", "string", False), ("c_nationkey", "int", True), ("c_acctbal", "double", True), ("c_mktsegment", "string", False)]
)
ORACLE["summary_statistics"] = union(
    f"""SELECT '{c}' AS feature, count({c})::BIGINT AS count, {r(f'avg({c}::DOUBLE)')} AS mean, {r(f'stddev_samp({c}::DOUBLE)')} AS std,
  {r(f'min({c})::DOUBLE')} AS min, {r(f'quantile_cont({c}::DOUBLE, 0.25)')} AS q1, {r(f'quantile_cont({c}::DOUBLE, 0.5)')} AS median,
  {r(f'quantile_cont({c}::DOUBLE, 0.75)')} AS q3, {r(f'max({c})::DOUBLE')} AS max FROM orders"""
    for c in ("o_totalprice", "o_custkey")
)
_GAPS = "(SELECT *, nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS t FROM lineitem)"
ORACLE["missing_values"] = f"""
SELECT * FROM ({union(
    f"SELECT '{n}' AS feature, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS missing, {r(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)')}::DOUBLE AS missing_pct FROM {_GAPS}"
    for n, c in (('l_quantity', 'l_quantity'), ('l_discount', 'd'), ('l_tax', 't'))
)}) WHERE missing > 0"""
ORACLE["distinct_values"] = union(
    f"SELECT '{c}' AS feature, (count(DISTINCT {c}) + coalesce(max(({c} IS NULL)::INT), 0))::BIGINT AS n_distinct FROM part"
    for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
)
ORACLE["constant_columns"] = "SELECT feature FROM (" + union(
    f"SELECT '{n}' AS feature, count(DISTINCT {c}) + max(({c} IS NULL)::INT) AS n FROM conversations"
    for n, c in (("conv_id", "conv_id"), ("turn", "turn"), ("role", "role"), ("text", "text"), ("kind", "'chat'"))
) + ") WHERE n <= 1"
ORACLE["identifier_columns"] = union(
    f"SELECT '{c}' AS feature, count(DISTINCT {c})::BIGINT AS n_distinct, count(*)::BIGINT AS n_rows, count(DISTINCT {c}) = count(*) AS is_identifier FROM customer"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
)
ORACLE["table_shape"] = "SELECT count(*)::BIGINT AS n_rows, 6 AS n_columns FROM events"
ORACLE["zero_audit"] = union(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} = 0)::BIGINT AS zeros, {r(f'count(*) FILTER (WHERE {c} = 0) * 100.0 / count(*)')}::DOUBLE AS zero_pct, {'TRUE' if c == 'l_discount' else 'FALSE'} AS zero_is_valid FROM lineitem"
    for c in MEASURES
)
ORACLE["mean_and_median"] = f"SELECT 'user_id' AS feature, {r('avg(user_id::DOUBLE)')} AS mean, {r('quantile_cont(user_id::DOUBLE, 0.5)')} AS median FROM events"
ORACLE["verification_summary"] = f"""
WITH d AS (SELECT DISTINCT * FROM labels), n AS (SELECT count(*) AS n FROM labels)
SELECT 'shape' AS section, 'rows' AS item, count(*)::DOUBLE AS number FROM labels
UNION ALL SELECT 'shape', 'columns', 3.0::DOUBLE
UNION ALL {union(f"SELECT 'missing', '{c}', count(*) FILTER (WHERE {c} IS NULL)::DOUBLE FROM labels" for c in ('doc_id', 'quality', 'toxic'))}
UNION ALL {union(f"SELECT 'distinct', '{c}', (count(DISTINCT {c}) + max(({c} IS NULL)::INT))::DOUBLE FROM labels" for c in ('doc_id', 'quality', 'toxic'))}
UNION ALL {union(f"SELECT 'constant', '{c}', 1.0::DOUBLE FROM labels HAVING count(DISTINCT {c}) + max(({c} IS NULL)::INT) <= 1" for c in ('doc_id', 'quality', 'toxic'))}
UNION ALL SELECT 'duplicates', 'rows', ((SELECT n FROM n) - (SELECT count(*) FROM d))::DOUBLE
UNION ALL SELECT 'target_pct', quality::VARCHAR, {r('count(*) * 100.0 / (SELECT n FROM n)')}::DOUBLE FROM labels GROUP BY quality"""
ORACLE["table_overview"] = f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem),
     o AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders),
     m AS (SELECT d.doc_id, d.lang, b.quality, b.toxic FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id)
SELECT 'lineitem' AS table_name, count(*)::BIGINT AS n_rows, 4 AS n_columns, 'l_returnflag' AS target,
  count(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS n_positive, {r("count(*) FILTER (WHERE l_returnflag = 'R') * 100.0 / count(*)")}::DOUBLE AS positive_pct,
  0::BIGINT AS n_missing, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM l)))::BIGINT AS n_duplicates, NULL::BOOLEAN AS id_is_unique FROM l
UNION ALL SELECT 'orders', count(*)::BIGINT, 3, 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT,
  {r("count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(*)")}::DOUBLE, 0::BIGINT,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM o)))::BIGINT, count(DISTINCT o_orderkey) = count(*) FROM o
UNION ALL SELECT 'labels', count(*)::BIGINT, 4, 'quality', count(*) FILTER (WHERE quality = 1)::BIGINT,
  {r("count(*) FILTER (WHERE quality = 1) * 100.0 / count(*)")}::DOUBLE,
  sum((lang IS NULL)::INT + (quality IS NULL)::INT + (toxic IS NULL)::INT)::BIGINT,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, quality, toxic FROM m)))::BIGINT, count(DISTINCT doc_id) = count(*) FROM m"""
ORACLE["value_counts"] = "SELECT o_orderpriority AS value, count(*)::BIGINT AS n FROM orders GROUP BY 1"
ORACLE["value_share"] = f"""
SELECT b.quality AS value, count(*)::BIGINT AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')}::DOUBLE AS pct
FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id GROUP BY b.quality"""
ORACLE["imbalance"] = f"""
SELECT count(*)::BIGINT AS n_classes, max(n)::BIGINT AS n_majority, min(n)::BIGINT AS n_minority, {r('max(n)::DOUBLE / min(n)')} AS ratio
FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic)"""


def _subjects(source: str, key: str) -> str:
    return f"""
WITH s AS (SELECT {key}, name, nullif(regexp_extract(name, '(S[0-9]+)', 1), '') AS coded, regexp_replace(name, '_[^_]*$', '') AS stem FROM ({source}))
SELECT {key}, name, CASE WHEN (SELECT bool_or(coded IS NULL) FROM s) THEN stem ELSE coded END AS subject_id FROM s"""


ORACLE["id_extract"] = _subjects("SELECT c_custkey, replace(c_name, '#', '_') AS name FROM customer", "c_custkey")
ORACLE["id_extract_coded"] = _subjects("SELECT s_suppkey, 'rec_S' || s_nationkey || '_' || s_suppkey AS name FROM supplier", "s_suppkey")
ORACLE["records_per_subject"] = "SELECT user_id AS subject, count(*)::BIGINT AS n FROM events GROUP BY 1 ORDER BY n DESC, subject LIMIT 20"
ORACLE["subject_coverage"] = "SELECT count(conv_id)::BIGINT AS n_rows_with_subject, count(DISTINCT conv_id)::BIGINT AS n_subjects FROM conversations"


def _iqr(name: str, x: str, source: str, base: str) -> str:
    whole = f"count({x})" if base == "valid" else "count(*)"
    out = f"count(*) FILTER (WHERE {x} < q25 - 1.5 * (q75 - q25) OR {x} > q75 + 1.5 * (q75 - q25))"
    return f"""
SELECT '{name}' AS feature, count({x})::BIGINT AS valid_count, {r('any_value(q25)')} AS q25, {r('any_value(q75)')} AS q75,
  {r('any_value(q75 - q25)')} AS iqr, {r('any_value(q25 - 1.5 * (q75 - q25))')} AS lower, {r('any_value(q75 + 1.5 * (q75 - q25))')} AS upper,
  {out}::BIGINT AS outliers, {r(f'{out} * 100.0 / {whole}')}::DOUBLE AS outlier_pct
FROM {source}, (SELECT quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.75) AS q75 FROM {source})"""


ORACLE["iqr_outliers"] = union(_iqr(m, m, "lineitem", "valid") for m in MEASURES)
ORACLE["iqr_outliers_with_gaps"] = union(_iqr(n, c, _GAPS, "all") for n, c in (("l_discount", "d"), ("l_tax", "t")))
ORACLE["outlier_rows"] = """
SELECT doc_id, n_chars FROM documents, (SELECT quantile_cont(n_chars::DOUBLE, 0.25) AS a, quantile_cont(n_chars::DOUBLE, 0.75) AS b FROM documents)
WHERE n_chars < a - 1.5 * (b - a) OR n_chars > b + 1.5 * (b - a)"""
ORACLE["box_by_class"] = union(
    f"""
SELECT l_returnflag, '{c}' AS feature, {r('any_value(q1)')} AS q1, {r('any_value(m)')} AS median, {r('any_value(q3)')} AS q3,
  {r(f'min({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {r(f'max({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  count(*) FILTER (WHERE {c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::BIGINT AS beyond
FROM lineitem JOIN (SELECT l_returnflag, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY 1) USING (l_returnflag)
GROUP BY l_returnflag"""
    for c in ("l_quantity", "l_extendedprice")
)


def _histogram(table: str, c: str, bins: str, by: str | None = None) -> str:
    keys = f"{by}, " if by else ""
    over = f"PARTITION BY {by}" if by else ""
    return f"""
WITH s AS (SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS n FROM {table}), k AS (SELECT *, {bins} AS bins FROM s),
h AS (SELECT {keys}lo, hi, bins, least(floor(({c} - lo) * bins / (hi - lo)), bins - 1)::BIGINT AS bucket FROM {table}, k WHERE {c} IS NOT NULL)
SELECT {keys}bucket, {r('lo + bucket * ((hi - lo) / bins)')} AS bin_start, count(*)::BIGINT AS n,
  {r(f'count(*) / (sum(count(*)) OVER ({over}) * ((hi - lo) / bins))')}::DOUBLE AS density
FROM h GROUP BY {keys}bucket, lo, hi, bins"""


ORACLE["histogram"] = _histogram("events", "value", "15")
ORACLE["histogram_sturges"] = _histogram("orders", "o_totalprice", "ceil(log2(n)) + 1")
ORACLE["histogram_by_class"] = _histogram("events", "value", "15", "event_type")
ORACLE["kde_grid"] = f"""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value)::DOUBLE AS n, stddev_samp(value) AS sd FROM events),
c AS (SELECT value AS v, count(*) AS cnt FROM events WHERE value IS NOT NULL GROUP BY value),
p AS (SELECT i::INT AS i, lo + i * ((hi - lo) / 49) AS x, n, sd * pow(n, -0.2) AS w FROM s, range(50) t(i))
SELECT i, {r('any_value(x)')} AS x, {r('sum(cnt * exp(-0.5 * pow((x - v) / w, 2))) / any_value(n * w * sqrt(2 * pi()))')} AS density
FROM p, c GROUP BY i"""


def _corr(a: str, b: str, source: str) -> str:
    return f"(SELECT corr({a}, {b}) FROM {source})"


ORACLE["corr_matrix"] = union(
    f"SELECT '{a}' AS row, '{b}' AS column, {i} AS i, {j} AS j, {r(f'corr({a}, {b})')} AS corr FROM lineitem"
    for i, a in enumerate(MEASURES) for j, b in enumerate(MEASURES)
)
_G = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "d", "l_tax": "t"}
ORACLE["corr_lower_triangle"] = union(
    f"SELECT '{a}' AS row, '{b}' AS column, {i} AS i, {j} AS j, {r(f'corr({_G[a]}, {_G[b]})')} AS corr FROM {_GAPS}"
    for i, a in enumerate(MEASURES) for j, b in enumerate(MEASURES) if j < i
)
ORACLE["corr_with_target"] = union(
    f"SELECT '{c}' AS feature, {r(f'''corr({c}, (l_returnflag = 'R')::INT)''')} AS corr FROM lineitem" for c in MEASURES
)
ORACLE["missing_rate_by_class"] = f"""
SELECT d.lang AS class, count(*)::BIGINT AS n, {r('avg((b.quality IS NULL)::INT) * 100')} AS missing_pct
FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id GROUP BY d.lang"""
ORACLE["prevalence_by_category"] = union(
    f"""SELECT '{c}' AS feature, d.{c} AS level, count(b.quality)::BIGINT AS n, {r('avg(b.quality::DOUBLE)')} AS rate, {r('avg(b.quality::DOUBLE) * 100')} AS rate_pct
FROM documents d JOIN labels b ON d.doc_id = b.doc_id GROUP BY d.{c}"""
    for c in ("lang", "source")
)
ORACLE["crosstab"] = """
SELECT o_orderpriority AS level, count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS "n_F",
  count(*) FILTER (WHERE o_orderstatus = 'O')::BIGINT AS "n_O", count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS "n_P"
FROM orders GROUP BY 1"""
_FLAGS = {"large": "(l_quantity > 25)::INT", "full_price": "(l_discount = 0)::INT", "finished": "(l_linestatus = 'F')::INT"}
ORACLE["flag_prevalence"] = union(
    f"SELECT '{n}' AS feature, {r(f'avg({x}) * 100')} AS pct FROM lineitem" for n, x in _FLAGS.items()
)
ORACLE["flag_rate_gap"] = union(
    f"""SELECT '{n}' AS feature, count(*) FILTER (WHERE {x} = 1)::BIGINT AS n_present,
  {r(f"avg((l_returnflag = 'R')::INT) FILTER (WHERE {x} = 1) * 100")} AS rate_present,
  {r(f"avg((l_returnflag = 'R')::INT) FILTER (WHERE {x} = 0) * 100")} AS rate_absent,
  {r(f"avg((l_returnflag = 'R')::INT) FILTER (WHERE {x} = 1) * 100 - avg((l_returnflag = 'R')::INT) FILTER (WHERE {x} = 0) * 100")} AS gap
FROM lineitem"""
    for n, x in _FLAGS.items()
)

ORACLE["zero_to_null"] = "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem"
ORACLE["zero_conversions"] = union(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} = 0)::BIGINT AS converted FROM lineitem" for c in ("l_discount", "l_tax", "l_quantity")
)
ORACLE["header_normalise"] = "SELECT c_custkey, c_name, c_nationkey AS nation_key, c_acctbal AS acctbal, c_mktsegment AS mkt_segment FROM customer"
ORACLE["label_map"] = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS code,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS label FROM orders"""
ORACLE["dictionary_lookup"] = """
SELECT c_nationkey, c_custkey, coalesce(n_name, 'unknown') AS n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
ORACLE["lenient_numbers"] = """
SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_no, TRY_CAST(p_type AS DOUBLE) AS type_no FROM part"""
ORACLE["unreadable_numbers"] = union(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL)::BIGINT AS unreadable FROM part"
    for c in ("p_name", "p_size", "p_type")
)
ORACLE["trimmed_text"] = """
SELECT doc_id, CASE WHEN lang NOT IN ('src0', 'fr') THEN lang END AS lang, CASE WHEN source NOT IN ('src0', 'fr') THEN source END AS source FROM documents"""
ORACLE["domain_violations"] = """
SELECT 'o_orderstatus' AS feature, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))::BIGINT AS violations FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))::BIGINT FROM orders"""
ORACLE["range_violations"] = """
SELECT 'c_acctbal' AS feature, count(*) FILTER (WHERE c_acctbal <= 0 OR c_acctbal > 9000)::BIGINT AS violations FROM customer
UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey <= 0 OR c_nationkey > 24)::BIGINT FROM customer"""
ORACLE["value_defects"] = """
SELECT 'l_tax' AS feature, count(*) FILTER (WHERE l_tax = 0)::BIGINT AS nulls, 0::BIGINT AS nans, 0::BIGINT AS infinities, 0::BIGINT AS blanks FROM lineitem
UNION ALL SELECT 'l_discount', 0, count(*) FILTER (WHERE l_discount = 0.01)::BIGINT, count(*) FILTER (WHERE l_discount = 0.02)::BIGINT, 0 FROM lineitem
UNION ALL SELECT 'l_linestatus', 0, 0, 0, count(*) FILTER (WHERE l_linestatus = 'F')::BIGINT FROM lineitem"""
ORACLE["known_targets_only"] = "SELECT vec_id, label FROM embeddings WHERE label IN (0, 1)"
ORACLE["feature_slices"] = f"""
SELECT vec_id, {', '.join(f"{r(f'list_avg(list_transform(embedding[{a}:{a + 15}], lambda x: x::DOUBLE))')} AS {n}" for n, a in (('first', 1), ('second', 17), ('third', 33), ('last', 49)))}
FROM embeddings"""

ORACLE["duplicate_rows"] = """
SELECT count(*)::BIGINT AS n_rows, count(DISTINCT text)::BIGINT AS n_distinct, (count(*) - count(DISTINCT text))::BIGINT AS n_duplicates FROM documents"""
ORACLE["drop_duplicate_rows"] = """
SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)"""
ORACLE["dedup_null_ids"] = """
WITH e AS (SELECT CASE WHEN event_id % 3 <> 0 THEN event_id % 50 END AS row_id, event_type,
  CASE user_id % 5 WHEN 0 THEN ['a, b'] WHEN 1 THEN ['a', 'b'] WHEN 2 THEN CAST([] AS VARCHAR[]) WHEN 3 THEN [NULL] END AS tags,
  CASE WHEN event_id % 2 = 0 THEN 0.0 ELSE event_id % 7 * 0.5 END::DOUBLE AS amount FROM events)
SELECT min(row_id) AS row_id, event_type, coalesce(len(tags), -1)::INT AS n_tags, CASE WHEN tags IS NULL THEN NULL WHEN tags = [NULL] THEN '?' ELSE coalesce(array_to_string(tags, '|'), '') END AS tags, amount
FROM e GROUP BY event_type, tags, amount"""
ORACLE["dup_groups"] = """
SELECT min(d.doc_id) AS first_row, count(*)::BIGINT AS n_rows, count(DISTINCT b.quality)::BIGINT AS n_labels
FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id GROUP BY d.text"""
ORACLE["conflicts"] = """
SELECT min(event_id) AS first_row, count(*)::BIGINT AS n_rows, count(DISTINCT event_type)::BIGINT AS n_labels
FROM events GROUP BY user_id, props HAVING count(DISTINCT event_type) > 1"""
ORACLE["duplicate_summary"] = """
SELECT count(*)::BIGINT AS n_groups, count(*) FILTER (WHERE n > 1)::BIGINT AS n_repeated_groups, sum(n - 1)::BIGINT AS n_duplicate_vectors, sum(n - k)::BIGINT AS n_duplicate_rows,
  count(*) FILTER (WHERE k > 1)::BIGINT AS n_conflicting_groups
FROM (SELECT count(*) AS n, count(DISTINCT l_returnflag) AS k FROM lineitem GROUP BY l_partkey, l_quantity)"""


# Splits: the naive form, one global rank per class


def _holdout(source: str, key: str, label: str, seed: int) -> str:
    """CTEs ending in ``split``: train sizes by largest remainder, then the rank inside the class."""
    return f"""
src AS ({source}),
sizes AS (SELECT {label} AS s, count(*) AS n, sum(count(*)) OVER () AS total FROM src GROUP BY 1),
shares AS (SELECT *, total - ceil(total * 0.2::DOUBLE) AS train, n * (total - ceil(total * 0.2::DOUBLE)) / total AS share FROM sizes),
quota AS (SELECT s, floor(share) + CASE WHEN row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, s) <= train - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k FROM shares),
split AS (SELECT src.*, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {key})) <= k THEN 'train' ELSE 'test' END AS split
  FROM src JOIN quota ON {label} = s)"""


ORACLE["stratified_split"] = f"WITH {_holdout('SELECT doc_id, quality FROM labels', 'doc_id', 'quality', 42)} SELECT * FROM split"
ORACLE["stratified_split_orders"] = f"WITH {_holdout('SELECT o_orderkey, o_orderstatus FROM orders', 'o_orderkey', 'o_orderstatus', 7)} SELECT * FROM split"


def _folds(source: str, key: str, label: str, k: int = 5, seed: int = 42) -> str:
    """CTEs ending in ``folds``: deal class-sorted positions to k hands, give each class's hash order those hand sizes."""
    return f"""
src AS ({source}),
dealt AS (SELECT s, (pos - 1) % {k} AS fold, count(*) AS n FROM (SELECT {label} AS s, row_number() OVER (ORDER BY {label}) AS pos FROM src) GROUP BY ALL),
upto AS (SELECT s, fold, sum(n) OVER (PARTITION BY s ORDER BY fold) AS hi, sum(n) OVER (PARTITION BY s ORDER BY fold) - n AS lo FROM dealt),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {key})) AS rn FROM src),
folds AS (SELECT ranked.*, fold::INT AS fold FROM ranked JOIN upto ON {label} = s AND rn > lo AND rn <= hi)"""


ORACLE["stratified_folds"] = f"""
WITH {_folds('SELECT o_orderkey, o_orderstatus FROM orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, fold FROM folds"""
ORACLE["class_distribution"] = f"""
SELECT split, l_returnflag AS label, count(*)::BIGINT AS n, {r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split)')}::DOUBLE AS pct
FROM (SELECT l_returnflag, CASE WHEN substr(md5(l_orderkey::VARCHAR), 1, 1) < '4' THEN 'test' ELSE 'train' END AS split FROM lineitem) GROUP BY split, l_returnflag"""
_ERRORS = "SELECT event_id, user_id, (event_type = 'error')::INT AS label FROM events"
_GROUPS = f"""SELECT user_id AS "group", count(*)::BIGINT AS n, sum(label)::BIGINT AS n_positive,
  (CASE WHEN sum(label) * 2 >= count(*) THEN '1' ELSE '0' END) || '-' || lpad((999 - floor(log2(count(*)))::INT)::VARCHAR, 3, '0') AS size_class FROM ({_ERRORS}) GROUP BY 1"""
_GROUP_FOLDS = _folds(_GROUPS, '"group"', "size_class")
ORACLE["group_folds"] = f'WITH {_GROUP_FOLDS} SELECT "group", n, n_positive, fold FROM folds'
_GROUP_SPLIT = f"""WITH {_GROUP_FOLDS}, rows AS (SELECT e.*, CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS split FROM ({_ERRORS}) e JOIN folds f ON e.user_id = f."group")"""
ORACLE["group_split"] = f"{_GROUP_SPLIT} SELECT event_id, user_id, label, split FROM rows"
ORACLE["split_report"] = f"""{_GROUP_SPLIT} SELECT split, count(*)::BIGINT AS n, sum(label)::BIGINT AS n_positive, count(DISTINCT user_id)::BIGINT AS n_groups,
  (round(sum(label) * 100.0 / count(*), 2) + 0.0)::DOUBLE AS positive_pct FROM rows GROUP BY split"""
ORACLE["groups_per_split"] = f"""
WITH {_holdout(_ERRORS, 'event_id', 'label', 42)}, spread AS (SELECT user_id, count(DISTINCT split) AS k FROM split GROUP BY 1)
SELECT split, count(*)::BIGINT AS n_rows, count(DISTINCT user_id)::BIGINT AS n_groups, count(DISTINCT user_id) FILTER (WHERE k > 1)::BIGINT AS n_shared_groups
FROM split JOIN spread USING (user_id) GROUP BY split"""
ORACLE["leakage_check"] = f"""
WITH {_holdout(_ERRORS, 'event_id', 'label', 42)}
SELECT user_id FROM split WHERE split = 'train' INTERSECT SELECT user_id FROM split WHERE split = 'test'"""
_EVENT_ROWS = "SELECT event_id, user_id, props, (event_type = 'error')::INT AS label FROM events"
_ALLOCATED = """SELECT CASE WHEN min(split) = max(split) THEN min(split) ELSE 'both' END AS allocation FROM {rows} GROUP BY user_id, props HAVING min(label) <> max(label)"""
ORACLE["conflict_allocation"] = f"""
SELECT allocation, count(*)::BIGINT AS n_vectors, 'whole' AS kind FROM ({_GROUP_SPLIT} {_ALLOCATED.format(rows='(SELECT r.*, e.props FROM rows r JOIN events e ON r.event_id = e.event_id)')}) GROUP BY 1
UNION ALL SELECT allocation, count(*)::BIGINT, 'cut' FROM (WITH {_holdout(_EVENT_ROWS, 'event_id', 'label', 42)} {_ALLOCATED.format(rows='split')}) GROUP BY 1"""
ORACLE["row_identity"] = "SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_ids FROM lineitem"
ORACLE["replayed_split"] = """
SELECT doc_id, lang, 'test' AS part FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
UNION ALL SELECT doc_id, lang, 'not_train' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS DISTINCT FROM 1)"""

# Feature preparation

_FILLED = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "d", "l_tax": "t"}


def _filled(name: str) -> str:
    x = _FILLED[name]
    return f"coalesce({x}, (SELECT quantile_cont({x}, 0.5) FROM {_GAPS}))"


ORACLE["numeric_statistics"] = union(
    f"SELECT '{m}' AS feature, {r(f'(SELECT quantile_cont({_FILLED[m]}, 0.5) FROM {_GAPS})')} AS median, {r('avg(x)')} AS mean, {r('stddev_pop(x)')} AS scale FROM (SELECT {_filled(m)} AS x FROM {_GAPS})"
    for m in MEASURES
)


def _scaled(name: str) -> str:
    x = _filled(name)
    return f"({x} - (SELECT avg({x}) FROM {_GAPS})) / (SELECT stddev_pop({x}) FROM {_GAPS})"


ORACLE["impute_scale_onehot"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, {r(_scaled('l_quantity'))} AS l_quantity, {r(_scaled('l_discount'))} AS l_discount, {r(_filled('l_tax'))} AS l_tax,
  {', '.join(f"(l_returnflag = '{v}')::INT::DOUBLE AS l_returnflag_{v}" for v in ('A', 'N', 'R'))},
  {', '.join(f"(l_linenumber = {v})::INT::DOUBLE AS l_linenumber_{v}" for v in range(1, 8))}
FROM {_GAPS}"""
ORACLE["category_levels"] = union(
    f"""SELECT '{c}' AS feature, {c}::VARCHAR AS level, count(*)::BIGINT AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) = 1 AS is_mode FROM part GROUP BY {c}"""
    for c in ("p_brand", "p_type", "p_size")
)
ORACLE["class_weights"] = f"""
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
SELECT doc_id, l.quality, {r('(SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * c.n)')} AS weight FROM labels l JOIN c ON l.quality = c.quality"""

# Metrics

_SCORED = """
SELECT l_linenumber AS fold, (l_returnflag = 'R')::INT AS label, 'price' AS model, l_extendedprice / 105000.0::DOUBLE AS score FROM lineitem
UNION ALL SELECT l_linenumber, (l_returnflag = 'R')::INT, 'quantity', l_quantity / 50.0::DOUBLE FROM lineitem
UNION ALL SELECT l_linenumber, (l_returnflag = 'R')::INT, 'discount', 1.0::DOUBLE - l_discount * 10.0::DOUBLE FROM lineitem"""
_CELLS = """count(*) FILTER (WHERE label = 0 AND score < 0.5)::BIGINT AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5)::BIGINT AS fp,
  count(*) FILTER (WHERE label = 1 AND score < 0.5)::BIGINT AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5)::BIGINT AS tp"""
ORACLE["confusion"] = f"SELECT model, {_CELLS} FROM ({_SCORED}) GROUP BY model"


def _ratio(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"


def _threshold_columns(wrap=r) -> str:
    recall, spec = _ratio("tp", "tp + fn"), _ratio("tn", "tn + fp")
    return f"""{wrap(_ratio('tp + tn', 'tp + tn + fp + fn'))} AS accuracy, {wrap(_ratio('tp', 'tp + fp'))} AS precision, {wrap(recall)} AS recall,
  {wrap(spec)} AS specificity, {wrap(f'({recall} + {spec}) / 2')} AS balanced_accuracy, {wrap(_ratio('tp * 2', 'tp * 2 + fp + fn'))} AS f1"""


ORACLE["threshold_metrics"] = f"SELECT model, tn, fp, fn, tp, {_threshold_columns()} FROM (SELECT model, {_CELLS} FROM ({_SCORED}) GROUP BY model)"


def _ranking(source: str, keys: str = "") -> str:
    """CTEs ending in ``ranks`` (roc_auc, avg_precision, pr_trapezoid per key)."""
    comma = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
tied AS (SELECT {comma}score, sum(label) AS pos, sum(1 - label) AS neg FROM ({source}) GROUP BY {comma}score),
curve AS (SELECT *, sum(pos) OVER ({part} ORDER BY score DESC) AS tp, sum(neg) OVER ({part} ORDER BY score DESC) AS fp,
  sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS q FROM tied),
ranks AS (SELECT {comma}sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / (any_value(p) * any_value(q))::DOUBLE AS roc_auc,
  sum(pos * tp / (tp + fp)::DOUBLE) / any_value(p) AS avg_precision,
  sum(pos * (tp / (tp + fp)::DOUBLE + coalesce((tp - pos)::DOUBLE / nullif(tp - pos + fp - neg, 0), 1)) / 2) / any_value(p) AS pr_trapezoid
  FROM curve {group})"""


_RANKS = f"{r('roc_auc')} AS roc_auc, {r('avg_precision')} AS avg_precision, {r('pr_trapezoid')} AS pr_trapezoid"
ORACLE["ranking_metrics"] = f"WITH {_ranking(_SCORED, 'model')} SELECT model, {_RANKS} FROM ranks"
_DOCS = """SELECT d.lang, b.quality AS label, d.n_chars / 10000.0::DOUBLE AS score, (d.n_chars >= 1500)::INT AS prediction FROM documents d JOIN labels b ON d.doc_id = b.doc_id"""
_DOC_CELLS = """count(*) FILTER (WHERE label = 0 AND prediction = 0)::BIGINT AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1)::BIGINT AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0)::BIGINT AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1)::BIGINT AS tp"""
ORACLE["roc_points"] = f"""
WITH {_ranking(_DOCS)} SELECT {r('score')} AS threshold, {r('fp / q::DOUBLE')} AS fpr, {r('tp / p::DOUBLE')} AS tpr FROM curve
UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE"""
ORACLE["pr_points"] = f"""
WITH {_ranking(_DOCS)} SELECT {r('score')} AS threshold, {r('tp / (tp + fp)::DOUBLE')} AS precision, {r('tp / p::DOUBLE')} AS recall FROM curve
UNION ALL SELECT NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE"""
ORACLE["all_metrics"] = f"""
WITH {_ranking(_DOCS)}, cells AS (SELECT {_DOC_CELLS} FROM ({_DOCS}))
SELECT tn, fp, fn, tp, {_threshold_columns()}, {_RANKS} FROM cells, ranks"""
ORACLE["class_report"] = f"""
WITH cells AS (SELECT {_DOC_CELLS} FROM ({_DOCS})),
c AS (SELECT '0' AS class, {_ratio('tn', 'tn + fn')} AS precision, {_ratio('tn', 'tn + fp')} AS recall, {_ratio('tn * 2', 'tn * 2 + fn + fp')} AS f1, tn + fp AS support FROM cells
  UNION ALL SELECT '1', {_ratio('tp', 'tp + fp')}, {_ratio('tp', 'tp + fn')}, {_ratio('tp * 2', 'tp * 2 + fp + fn')}, tp + fn FROM cells),
rows AS (SELECT * FROM c
  UNION ALL SELECT 'accuracy', {_ratio('tp + tn', 'tp + tn + fp + fn')}, {_ratio('tp + tn', 'tp + tn + fp + fn')}, {_ratio('tp + tn', 'tp + tn + fp + fn')}, tp + tn + fp + fn FROM cells
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM c
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM c)
SELECT class, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, support::BIGINT AS support FROM rows"""
_NAMES = ("accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "roc_auc", "avg_precision", "pr_trapezoid")
_FOLD = f"""WITH {_ranking(_SCORED, 'model, fold')},
cells AS (SELECT model, fold, {_CELLS} FROM ({_SCORED}) GROUP BY model, fold),
m AS (SELECT model, fold, {_threshold_columns(lambda x: x)}, roc_auc, avg_precision, pr_trapezoid FROM cells JOIN ranks USING (model, fold)),
summary AS (SELECT model, {', '.join(f'avg({n}) AS {n}_mean, stddev_pop({n}) AS {n}_std' for n in _NAMES)} FROM m GROUP BY model)"""
ORACLE["fold_summary"] = f"{_FOLD} SELECT model, {', '.join(f'{r(n + s)} AS {n + s}' for n in _NAMES for s in ('_mean', '_std'))} FROM summary"
ORACLE["champion"] = f"""{_FOLD} SELECT model FROM summary
ORDER BY roc_auc_mean DESC, avg_precision_mean DESC, balanced_accuracy_mean DESC, specificity_mean DESC, model LIMIT 1"""
ORACLE["metric_defects"] = f"""{_FOLD} {union(f"SELECT '{n}' AS metric, count(*) FILTER (WHERE isnan({n}) OR {n} < 0 OR {n} > 1)::BIGINT AS defects FROM m" for n in _NAMES)}"""


# Scoring

_P = "1.0::DOUBLE / (1.0 + exp(-(-0.25::DOUBLE + 0.0002::DOUBLE * c_acctbal + -0.05::DOUBLE * c_nationkey)))"
ORACLE["linear_score"] = f"""
SELECT c_custkey, (p > 0.5)::INT AS prediction, CASE WHEN p > 0.5 THEN 'positive' ELSE 'negative' END AS prediction_label,
  round(p, 4) AS probability, round(p * 100.0::DOUBLE, 2) AS risk_percentage FROM (SELECT c_custkey, {_P} AS p FROM customer)"""
ORACLE["risk_tiers"] = """
WITH s AS (SELECT CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE / (1.0 + exp(-(-1.0::DOUBLE + 0.1::DOUBLE * nullif(value, 1.0)))) END AS p FROM events)
SELECT CASE WHEN p IS NULL THEN 'unknown' WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'moderate' ELSE 'high' END AS tier,
  CASE WHEN p >= 0.5 THEN 'elevated_screening_signal' ELSE 'lower_screening_signal' END AS signal, count(*)::BIGINT AS n FROM s GROUP BY ALL"""
ORACLE["vector_score"] = """
SELECT vec_id, round(1.0::DOUBLE / (1.0 + exp(-(0.25::DOUBLE + list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * ((i % 5) - 2)))))), 6) + 0.0 AS probability FROM embeddings"""

_K = "CAST(json_extract_string(props, '$.k') AS INT)"
_FLAG_NAMES = [n for n in WEIGHTS if n not in ("gender", "age")]


def _flag_message(f: str) -> str:
    kind, text = f"json_type(d, '$.{f}')", f"json_extract_string(d, '$.{f}')"
    tail = "Expected 0, 1, YES, or NO."
    return f"""CASE WHEN {kind} = 'NULL' THEN 'Feature ''{f}'' cannot be None.'
  WHEN {kind} = 'BOOLEAN' THEN 'Invalid value for {f}: ' || CASE {text} WHEN 'true' THEN 'True' ELSE 'False' END || '. Boolean values (True/False) are not accepted. {tail}'
  WHEN {kind} = 'VARCHAR' AND upper(trim({text})) NOT IN ('YES', 'NO', '0', '1') THEN 'Invalid value for {f}: ''' || {text} || '''. {tail}'
  WHEN {kind} NOT IN ('VARCHAR', 'BOOLEAN', 'NULL') AND {text} NOT IN ('0', '1') THEN 'Invalid value for {f}: ' || {text} || '. {tail}' END"""


_GENDER = """CASE WHEN json_type(d, '$.gender') = 'NULL' THEN 'Feature ''gender'' cannot be None.'
  WHEN json_type(d, '$.gender') = 'BOOLEAN' THEN 'Invalid value for gender: ' || CASE json_extract_string(d, '$.gender') WHEN 'true' THEN 'True' ELSE 'False' END || '. Boolean values are not accepted.'
  WHEN json_type(d, '$.gender') = 'VARCHAR' AND upper(trim(json_extract_string(d, '$.gender'))) NOT IN ('MALE', 'FEMALE', '0', '1')
    THEN 'Invalid value for gender: ''' || json_extract_string(d, '$.gender') || '''. Expected ''MALE'' or ''FEMALE''.'
  WHEN json_type(d, '$.gender') <> 'VARCHAR' AND json_extract_string(d, '$.gender') NOT IN ('0', '1')
    THEN 'Invalid numeric value for gender: ' || json_extract_string(d, '$.gender') || '. Expected 0 (FEMALE) or 1 (MALE).' END"""
_AGE = """CASE WHEN json_type(d, '$.age') = 'NULL' THEN 'Feature ''age'' cannot be None.'
  WHEN json_type(d, '$.age') = 'BOOLEAN' THEN 'Invalid value for age: ' || CASE json_extract_string(d, '$.age') WHEN 'true' THEN 'True' ELSE 'False' END || '. Boolean values are not accepted.'
  WHEN TRY_CAST(json_extract_string(d, '$.age') AS DOUBLE) IS NULL THEN 'Invalid non-numeric value for age: ''' || json_extract_string(d, '$.age') || '''.'
  WHEN TRY_CAST(json_extract_string(d, '$.age') AS DOUBLE) <= 0 THEN 'Age must be positive (greater than 0). Received: ' || json_extract_string(d, '$.age')
  WHEN TRY_CAST(json_extract_string(d, '$.age') AS DOUBLE) > 120 THEN 'Age exceeds realistic human limit (120). Received: ' || json_extract_string(d, '$.age') END"""
_MESSAGES = [_GENDER, _AGE, *[_flag_message(f) for f in _FLAG_NAMES]]
_EXPECTED = "[" + ", ".join(f"'{f}'" for f in WEIGHTS) + "]"


def _code(f: str) -> str:
    if f == "age":
        return "TRY_CAST(json_extract_string(d, '$.age') AS DOUBLE)"
    return f"CASE WHEN upper(trim(json_extract_string(d, '$.{f}'))) IN ('MALE', 'YES', '1') THEN 1.0 ELSE 0.0 END::DOUBLE"


_CHECKED = f"""
WITH b AS (SELECT event_id, {BODY.format(k=_K, text='VARCHAR')} AS body FROM events),
j AS (SELECT *, json_valid(body) AS ok, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS t FROM b),
x AS (SELECT *, json_keys(t) AS top, coalesce(json_keys(t, '$.data'), []) AS inside, json_type(t, '$.disease') AS dk, json_extract_string(t, '$.disease') AS dt,
  json_type(t, '$.data') AS tk, json_type(t, '$.mode') AS mk, json_extract_string(t, '$.mode') AS mt,
  CASE WHEN json_type(t, '$.data') = 'OBJECT' THEN json_extract(t, '$.data') ELSE '{{}}'::JSON END AS d FROM j),
e AS (SELECT *, CASE
  WHEN trim(body) = '' THEN 'Request body cannot be empty.'
  WHEN NOT ok THEN 'Malformed JSON in request body.'
  WHEN json_type(t) <> 'OBJECT' THEN 'Request body must contain a valid JSON object.'
  WHEN len(list_distinct(inside)) < len(inside) THEN 'Duplicate JSON field: age'
  WHEN len(list_distinct(top)) < len(top) THEN 'Duplicate JSON field: disease'
  WHEN NOT list_contains(top, 'disease') THEN 'Missing required field ''disease''.'
  WHEN NOT list_contains(top, 'data') THEN 'Missing required field ''data''.'
  WHEN dk = 'NULL' THEN 'Field ''disease'' is required and cannot be null.'
  WHEN dk <> 'VARCHAR' OR trim(dt) = '' THEN 'Invalid disease identifier: ''' || dt || '''. Must be a non-empty string.'
  WHEN lower(trim(dt)) <> 'lung_cancer' THEN 'Unsupported disease ''' || dt || '''. Supported diseases: [''lung_cancer''].'
  WHEN tk = 'NULL' THEN 'Field ''data'' is required and cannot be null.'
  WHEN tk <> 'OBJECT' THEN 'Field ''data'' must be a valid JSON object. Received str.'
  WHEN len(inside) = 0 THEN 'Field ''data'' cannot be an empty object.'
  WHEN mk = 'VARCHAR' AND lower(trim(mt)) NOT IN ('user', 'clinical') THEN 'Invalid mode ''' || mt || '''. Supported modes: [''user'', ''clinical''].' END AS envelope FROM x),
f AS (SELECT *, CASE
  WHEN envelope IS NOT NULL THEN NULL
  WHEN list_contains(inside, 'weight') THEN 'Unexpected feature encountered: weight'
  WHEN NOT list_contains(inside, 'coughing') THEN 'Missing required feature: coughing' END AS shape,
  [{', '.join(_MESSAGES)}] AS found FROM e),
c AS (SELECT *, CASE WHEN envelope IS NULL AND shape IS NULL THEN list_filter(found, lambda m: m IS NOT NULL) ELSE [] END AS errors FROM f),
checked AS (SELECT *, coalesce(envelope, shape, errors[1]) AS message,
  CASE WHEN trim(body) = '' OR NOT ok OR json_type(t) <> 'OBJECT' THEN 'invalid_request' WHEN coalesce(envelope, shape, errors[1]) IS NOT NULL THEN 'validation_error' END AS error_type FROM c),
scored AS (SELECT *, CASE WHEN message IS NULL THEN 1.0::DOUBLE / (1.0 + exp(-({INTERCEPT}::DOUBLE + {' + '.join(f'{w}::DOUBLE * {_code(f)}' for f, w in WEIGHTS.items())}))) END AS p FROM checked)"""
ORACLE["validate_requests"] = f"""{_CHECKED}
SELECT event_id, CASE WHEN message IS NULL THEN 'success' ELSE 'error' END AS status, error_type, message, len(errors)::INT AS n_errors FROM checked"""
ORACLE["answer_requests"] = f"""{_CHECKED}
SELECT event_id, CASE WHEN message IS NULL THEN 'success' ELSE 'error' END AS status,
  CASE WHEN dk = 'VARCHAR' AND lower(trim(dt)) = 'lung_cancer' AND coalesce(message, '') <> 'Duplicate JSON field: disease' AND coalesce(message, '') <> 'Duplicate JSON field: age' THEN 'lung_cancer' END AS disease,
  CASE WHEN envelope IS NULL THEN CASE WHEN mk = 'VARCHAR' THEN lower(trim(mt)) ELSE 'user' END END AS mode,
  (p > 0.5)::INT AS prediction, CASE WHEN p > 0.5 THEN 'YES' WHEN p IS NOT NULL THEN 'NO' END AS prediction_label,
  round(p, 4) AS probability, round(p * 100.0::DOUBLE, 2) AS risk_percentage, CASE WHEN message IS NULL THEN 200 ELSE 400 END AS status_class FROM scored"""
ORACLE["stream_score"] = ORACLE["answer_requests"]
ORACLE["request_outcomes"] = f"""{_CHECKED}
SELECT CASE WHEN message IS NULL THEN 200 ELSE 400 END AS status_class, error_type, count(*)::BIGINT AS n FROM checked GROUP BY ALL"""
ORACLE["quarantine"] = f"{_CHECKED} SELECT event_id, message FROM checked WHERE message IS NOT NULL"
ORACLE["redacted_paths"] = r"""
SELECT page_id, regexp_replace('failed at ' || url, '\b[A-Za-z]:[\\/]\S+|(?:/[\w.-]+){2,}', '[redacted_path]', 'g') AS message FROM pages"""

# Requests of all diseases: the rules as rows, judged field by field over the parsed bodies.


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _rule_rows(served) -> str:
    rows = []
    for name, one in served.items():
        for i, r in enumerate(one.contract.rules):
            say = routing.rule_row(r)[-1]
            weights = one.weights or {}
            mine = {k.removeprefix(f"{r.name}="): v for k, v in weights.items() if k.startswith(f"{r.name}=")}
            levels = "MAP {" + ", ".join(f"{_text(k)}: {v}::DOUBLE" for k, v in mine.items()) + "}" if mine else "NULL"
            codes = "MAP {" + ", ".join(f"{_text(k)}: {v}::DOUBLE" for k, v in r.codes.items()) + "}" if r.codes else "NULL"
            bounds = [f"{'NULL' if x is None else x}::DOUBLE" for x in (r.above, r.at_most, weights.get(r.name, 0.0))]
            texts = [_text(say[k]) for k in ("null", "bool", "text", "number", "nan", "infinite", "low", "high", "other")]
            values = [_text(name), i, _text(r.name), r.text, r.nullable, r.codes is not None, r.allow_boolean, r.style != "gender", codes, *bounds, levels, _text(one.filled.get(r.name)), *texts]
            rows.append("(" + ", ".join(map(str, values)) + ")")
    return ", ".join(rows)


def _answered(body: str, served, flat: str = "NULL") -> str:
    """CTEs up to ``answers``; ``flat`` is SQL for what a grouped payload comes to, as a flat JSON object."""
    first = {n for n, one in served.items() if one.contract.model_first}
    lenient = {n for n, one in served.items() if not one.contract.refuses_extra}
    down = {n for n, one in served.items() if not one.ready}
    names = lambda items: "(" + ", ".join(_text(n) for n in [*sorted(items), ""]) + ")"
    listed = "[" + ", ".join(f"'{n}'" for n in sorted(served)) + "]"
    number = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return rf"""
WITH b AS (SELECT event_id, {body.format(k=_K, text='VARCHAR')} AS body, {flat.format(k=_K, text='VARCHAR')} AS flat FROM events),
x AS (SELECT event_id, lower(trim(json_extract_string(body, '$.disease'))) AS d, json_extract_string(body, '$.disease') AS sent, coalesce(flat::JSON, json_extract(body, '$.data')) AS data,
  json_extract_string(body, '$.mode') AS mt FROM b),
e AS (SELECT event_id, d, data, CASE WHEN d NOT IN {names(served)} THEN 'Unsupported disease ''' || sent || '''. Supported diseases: ' || {_text(listed)} || '.'
  WHEN lower(trim(coalesce(mt, 'user'))) NOT IN ('user', 'clinical') THEN 'Invalid mode ''' || mt || '''. Supported modes: [''user'', ''clinical''].' END AS envelope,
  lower(trim(coalesce(mt, 'user'))) AS mode FROM x),
rules(d, pos, feature, is_text, nullable, coded, booleans, tells_nan, codes, above, at_most, weight, levels, fill, m_null, m_bool, m_text, m_number, m_nan, m_infinite, m_low, m_high, m_other)
  AS (VALUES {_rule_rows(served)}),
v AS (SELECT e.event_id, r.*, json_extract(data, '$."' || feature || '"') AS j FROM e JOIN rules r ON r.d = e.d WHERE envelope IS NULL),
k AS (SELECT *, json_type(j) AS kind, CASE WHEN json_type(j) = 'VARCHAR' THEN json_extract_string(j, '$') ELSE j::VARCHAR END AS t FROM v),
n AS (SELECT *, CASE WHEN kind = 'BOOLEAN' THEN upper(t[1]) || t[2:] ELSE t END AS shown, CASE
  WHEN is_text OR kind IN ('OBJECT', 'ARRAY', 'NULL') THEN NULL WHEN kind = 'BOOLEAN' THEN CASE WHEN t = 'true' THEN 1.0 ELSE 0.0 END::DOUBLE
  WHEN coded AND kind = 'VARCHAR' THEN codes[upper(trim(t))] WHEN coded THEN CASE WHEN list_contains(map_values(codes), try_cast(t AS DOUBLE)) THEN try_cast(t AS DOUBLE) END
  WHEN lower(trim(t)) IN ('nan', 'infinity', '-infinity') THEN try_cast(trim(t) AS DOUBLE) WHEN regexp_matches(trim(t), '{number}') THEN try_cast(trim(t) AS DOUBLE) END AS num FROM k),
m AS (SELECT *, CASE WHEN kind = 'NULL' THEN CASE WHEN nullable THEN NULL ELSE m_null END
  WHEN is_text THEN CASE WHEN kind IN ('OBJECT', 'ARRAY') THEN replace(m_text, '%s', shown) END
  WHEN kind = 'BOOLEAN' AND NOT booleans THEN replace(m_bool, '%s', shown)
  WHEN (coalesce(isnan(num), false) OR (coded AND t = 'NaN')) AND tells_nan THEN CASE WHEN nullable THEN NULL ELSE m_nan END
  WHEN (coalesce(isinf(num), false) OR (coded AND t IN ('Infinity', '-Infinity'))) AND tells_nan THEN m_infinite
  WHEN num IS NULL AND (NOT coded OR kind = 'VARCHAR') THEN replace(m_text, '%s', shown) WHEN num IS NULL AND kind IN ('OBJECT', 'ARRAY') THEN replace(m_other, '%s', shown)
  WHEN num IS NULL THEN replace(m_number, '%s', shown) WHEN num <= above THEN replace(m_low, '%s', shown) WHEN num > at_most THEN replace(m_high, '%s', shown) END AS message,
  CASE WHEN is_text THEN coalesce(levels[coalesce(CASE WHEN kind <> 'NULL' THEN regexp_replace(t, '^([+-]?[0-9]+)\.0+$', '\1') END, fill)], 0)
    ELSE weight * coalesce(CASE WHEN NOT isnan(num) THEN num END, try_cast(fill AS DOUBLE), 0) END AS term FROM n),
g AS (SELECT event_id, arg_min(message, pos) FILTER (WHERE message IS NOT NULL) AS fault, list(feature ORDER BY pos) FILTER (WHERE j IS NULL) AS missing, sum(term) AS terms, list(feature) AS expected
  FROM m GROUP BY event_id),
w AS (SELECT e.event_id, e.d, mode, envelope, fault, missing, terms, list_filter(json_keys(data), lambda f: NOT list_contains(expected, f)) AS extras FROM e LEFT JOIN g ON g.event_id = e.event_id),
s AS (SELECT *, CASE WHEN envelope IS NOT NULL THEN envelope WHEN d IN {names(first & down)} THEN '!'
  WHEN d NOT IN {names(lenient)} AND len(extras) > 0 THEN 'Unexpected feature encountered: ' || extras[1]
  WHEN len(missing) > 0 AND d IN {names(first)} THEN 'Missing required features: [''' || array_to_string(missing, ''', ''') || ''']' WHEN len(missing) > 0 THEN 'Missing required feature: ' || missing[1]
  WHEN fault IS NOT NULL THEN fault WHEN d IN {names(down)} THEN '!' END AS said FROM w),
p AS (SELECT *, CASE WHEN said IS NULL THEN 1.0::DOUBLE / (1.0 + exp(-(0.125 + terms)::DOUBLE)) END AS p FROM s),
answers AS (SELECT event_id, CASE WHEN said IS NULL THEN 'success' ELSE 'error' END AS status, CASE WHEN d IN {names(served)} THEN d END AS disease, CASE WHEN envelope IS NULL THEN mode END AS mode,
  CASE WHEN said = '!' THEN 'service_error' WHEN said IS NOT NULL THEN 'validation_error' END AS error_type,
  CASE WHEN said = '!' THEN 'An internal error occurred in the disease prediction service.' ELSE said END AS message, (p > 0.5)::INT AS prediction,
  CASE WHEN p IS NULL THEN NULL WHEN d = 'lung_cancer' THEN CASE WHEN p > 0.5 THEN 'YES' ELSE 'NO' END WHEN d = 'breast_cancer' THEN CASE WHEN p > 0.5 THEN 'Malignant' ELSE 'Benign' END
    WHEN d = 'asthma' THEN CASE WHEN p > 0.5 THEN 'Has asthma' ELSE 'No asthma' END WHEN d = 'parkinsons' THEN CASE WHEN p > 0.5 THEN 'Parkinson''s disease screening positive' ELSE 'Healthy' END
    WHEN p > 0.5 THEN 'positive' ELSE 'negative' END AS prediction_label,
  CASE WHEN d <> 'stroke' THEN round(p, 4) END AS probability,
  CASE WHEN p IS NULL THEN NULL WHEN d = 'stroke' THEN 'unknown' WHEN d IN ('heart', 'diabetes') THEN CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'moderate' ELSE 'high' END
    WHEN d IN ('asthma', 'parkinsons') THEN CASE WHEN p >= 0.5 THEN 'elevated_screening_signal' ELSE 'lower_screening_signal' END END AS risk_category,
  CASE WHEN said IS NULL THEN 200 WHEN said = '!' THEN 503 ELSE 400 END AS status_class FROM p)"""


def _flat_grouped() -> str:
    """The grouped request's fields as they come out: the loose value where there is one, else the listed or grouped one."""
    loose = {0: "CASE WHEN {k} % 5 = 0 THEN '1000' ELSE _ END", 12: "CASE WHEN {k} % 5 = 1 THEN 'null' ELSE _ END"}
    values = [loose.get(i, "_").replace("_", request_number(i)) for i in range(30)]
    pairs = [f"""', "{f}": ' || {v}""" for f, v in zip(contracts.BREAST_FEATURES, values, strict=True)]
    worst = "CASE WHEN {k} % 7 = 0 THEN '' ELSE " + " || ".join(pairs[20:]) + " END"
    return "'{{' || substr(" + " || ".join(pairs[:20]) + f""" || {worst}, 3) || CASE WHEN {{k}} % 5 = 2 THEN ', "stranger": 1' ELSE '' END || '}}}}'"""


ORACLE["answer_mixed_requests"] = _answered(mixed_body(), mixed_served()) + " SELECT * FROM answers"
ORACLE["grouped_requests"] = _answered(grouped_body(), mixed_served(), _flat_grouped()) + " SELECT * FROM answers"
ORACLE["missing_model_requests"] = _answered(mixed_body(), mixed_served(("heart", "diabetes", "lung_cancer"))) + """
SELECT disease, status_class, error_type, count(*)::BIGINT AS n FROM answers GROUP BY ALL"""
ORACLE["strict_requests"] = _answered(mixed_body(), mixed_served()) + """
SELECT event_id, disease, prediction, risk_category FROM answers WHERE status = 'success'"""

# Sources

ORACLE["fingerprint"] = """
SELECT count(*)::BIGINT AS n_rows, sum(h)::DECIMAL(38, 0) AS checksum, bit_xor(h)::BIGINT AS xor
FROM (SELECT ('0x' || substr(md5(concat_ws('|', """ + ", ".join(
    f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "text", "lang", "source", "n_chars")
) + """)), 1, 14))::BIGINT AS h FROM documents)"""
ORACLE["input_schema"] = union(
    f"SELECT '{c}' AS name, '{kind}' AS dtype, count({c})::BIGINT AS n_present, max(length({c}::VARCHAR))::INT AS widest FROM orders"
    for c, kind in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))
)
_AFTER = "(SELECT * FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text))"
ORACLE["cleaning_audit"] = union(
    f"""SELECT '{c}' AS feature, (SELECT count(*) FROM documents)::BIGINT AS rows_before, (SELECT count(*) FILTER (WHERE {c} IS NULL OR {gap}) FROM documents)::BIGINT AS missing_before,
  (SELECT count(*) FILTER (WHERE {zero}) FROM documents)::BIGINT AS zeros_before,
  count(*)::BIGINT AS rows_after, count(*) FILTER (WHERE {c} IS NULL OR {gap} OR {c}::VARCHAR = 'fr')::BIGINT AS missing_after, count(*) FILTER (WHERE {zero})::BIGINT AS zeros_after,
  (round(count(*) * 100.0 / (SELECT count(*) FROM documents), 2))::DOUBLE AS preserved_pct FROM {_AFTER}"""
    for c, gap, zero in (("lang", "false", "false"), ("source", "false", "false"), ("text", "false", "try_cast(md5(text) AS DOUBLE) = 0"), ("n_chars", "n_chars = 5", "n_chars = 0"))
)
ORACLE["comparison_rows"] = f"""{_FOLD} SELECT model, format('| {{}} | {{:.4f}} ± {{:.4f}} | {{:.4f}} ± {{:.4f}} |', model, roc_auc_mean, roc_auc_std, f1_mean, f1_std) AS line FROM summary"""
ORACLE["feature_dictionary"] = f"""
SELECT f.*, f.role <> 'predictor' AS is_excluded, m.missing, m.missing_pct FROM (
  SELECT 'l_quantity' AS feature, 'number' AS logical_type, 'predictor' AS role, 'none' AS cleaning_action, 'units' AS reason
  UNION ALL SELECT 'l_discount', 'number', 'predictor', 'zero to missing', 'rate' UNION ALL SELECT 'l_orderkey', 'id', 'identifier', 'drop', 'key') f
JOIN ({union(f"SELECT '{n}' AS feature, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS missing, {r(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)')}::DOUBLE AS missing_pct FROM {_GAPS}" for n, c in (('l_quantity', 'l_quantity'), ('l_discount', 'd'), ('l_orderkey', 'l_orderkey')))}) m USING (feature)"""

# Models with a closed form

_PRIORITY = "SELECT o_orderkey, (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS label, o_orderstatus, (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))::INT AS upper FROM orders"
_CLOSED = f"""
WITH {_folds(_PRIORITY, 'o_orderkey', 'label', 3)},
levels AS (SELECT f.o_orderkey, f.fold, avg(t.label) AS score FROM (SELECT DISTINCT o_orderkey, fold, o_orderstatus FROM folds) f
  JOIN (SELECT k.fold, o_orderstatus, avg(label) AS label FROM folds, (SELECT DISTINCT fold FROM folds) k WHERE folds.fold <> k.fold GROUP BY ALL) t ON t.fold = f.fold AND t.o_orderstatus = f.o_orderstatus GROUP BY ALL),
stump AS (SELECT f.o_orderkey, f.fold, t.label AS score FROM folds f
  JOIN (SELECT k.fold, upper, avg(label) AS label FROM folds, (SELECT DISTINCT fold FROM folds) k WHERE folds.fold <> k.fold GROUP BY ALL) t ON t.fold = f.fold AND t.upper = f.upper),
scores AS (SELECT m.model, f.fold, f.o_orderkey, f.label, (m.score > 0.5)::INT AS prediction, m.score
  FROM (SELECT 'levels' AS model, * FROM levels UNION ALL SELECT 'stump', * FROM stump) m JOIN folds f USING (o_orderkey))"""
ORACLE["cv_scores"] = f"{_CLOSED} SELECT model, fold, o_orderkey, label, prediction, {r('score', 3)}::DOUBLE AS score FROM scores"
ORACLE["cv_metrics"] = f"""{_CLOSED}
SELECT model, fold, sum((label = 1 AND prediction = 1)::INT)::BIGINT AS tp, sum((label = 0 AND prediction = 1)::INT)::BIGINT AS fp, sum((label = 0 AND prediction = 0)::INT)::BIGINT AS tn,
  sum((label = 1 AND prediction = 0)::INT)::BIGINT AS fn, {r('avg((label = prediction)::INT)', 4)}::DOUBLE AS accuracy, {r('avg(CASE WHEN label = 1 THEN prediction END)', 4)}::DOUBLE AS recall
FROM scores GROUP BY model, fold"""
ORACLE["level_coefficients"] = f"""
SELECT 'o_orderstatus_' || o_orderstatus AS feature, {r('ln(avg(label) / (1 - avg(label)))', 3)}::DOUBLE AS log_odds FROM ({_PRIORITY}) GROUP BY o_orderstatus"""
ORACLE["encode_many_levels"] = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'common' WHEN o_orderkey % 50 <> 1 THEN o_orderkey::VARCHAR END AS level FROM orders),
d AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS slot FROM (SELECT DISTINCT level FROM o WHERE level IS NOT NULL AND o_orderkey % 11 <> 0))
SELECT o_orderkey, coalesce(slot, (SELECT count(*) FROM d)) AS slot, (SELECT count(*) FROM d) AS n_slots FROM o LEFT JOIN d ON d.level = coalesce(o.level, 'common')"""
ORACLE["nested_duplicates"] = f"""
SELECT event_id, 'validation_error' AS error_type, coalesce('Duplicate JSON field: ' || CASE {_K} % {len(NESTED)} {' '.join(f"WHEN {i} THEN {_text(key)}" for i, (_, key) in enumerate(NESTED))} END,
  'Unsupported disease ''unknown''. Supported diseases: [''heart''].') AS message FROM events"""
ORACLE["merged_summaries"] = union(
    f"""SELECT '{c}' AS feature, count(*)::BIGINT AS n, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS missing, {r(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)', 4)}::DOUBLE AS missing_pct,
  {f'count(*) FILTER (WHERE {c} = 0)' if numeric else 'NULL'}::BIGINT AS zeros, {f'{r(f"min({c})::DOUBLE", 4)}' if numeric else 'NULL'}::DOUBLE AS min, {f'{r(f"max({c})::DOUBLE", 4)}' if numeric else 'NULL'}::DOUBLE AS max,
  {f'{r(f"avg({c}::DOUBLE)", 4)}' if numeric else 'NULL'}::DOUBLE AS mean, {f'{r(f"stddev_samp({c}::DOUBLE)", 4)}' if numeric else 'NULL'}::DOUBLE AS std, true AS n_distinct_close FROM lineitem"""
    for c, _, numeric in _LINE
)
_MANY = [(f"{m}_{d}", f"CASE WHEN l_orderkey % {d} <> 0 THEN {m} END") for m in MEASURES for d in (2, 3, 5, 7)]
ORACLE["corr_many_columns"] = f"WITH c AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _MANY)} FROM lineitem) " + union(
    f"SELECT '{a}' AS row, '{b}' AS column, {i} AS i, {j} AS j, {r(f'corr({a}, {b})', 5)}::DOUBLE AS corr FROM c"
    for i, (a, _) in enumerate(_MANY) for j, (b, _) in enumerate(_MANY[:i])
)
ORACLE["stream_model_swap"] = _answered(mixed_body(), mixed_served()) + """
SELECT a.event_id, CASE WHEN a.disease IS NOT NULL THEN 1 + a.event_id % 2 END::INT AS model_version, a.disease, a.status,
  CASE WHEN a.event_id % 2 = 0 THEN p > 0.5 ELSE p < 0.5 END::INT AS prediction,
  CASE WHEN a.disease <> 'stroke' THEN round(round(CASE WHEN a.event_id % 2 = 0 THEN p ELSE 1 - p END, 4), 3) END AS probability
FROM answers a JOIN p USING (event_id)"""
ORACLE["model_registry"] = _answered(mixed_body(), mixed_served()) + ", info(disease, version, model, threshold, feature_count, status) AS (VALUES " + ", ".join(
    f"('{n}', {2 if n in ('stroke', 'diabetes') else 1}, {_text(one.contract.model_name)}, 0.5::DOUBLE, {len(one.contract.rules)}, '{'unavailable' if n == 'stroke' else 'ready'}')"
    for n, one in mixed_served().items()) + """)
SELECT info.*, n AS n_requests FROM info LEFT JOIN (SELECT disease, count(*)::BIGINT AS n FROM answers GROUP BY 1) c USING (disease)"""
