"""SQL building blocks of the oracles (DuckDB dialect, run on the same
parquet tables as views). They mirror the stand-in builders in
``tabtext.sources.standins`` and never call the library."""

U32 = "('0x' || substr(md5({key}), 1, 8))::BIGINT"


def u32(*parts: str) -> str:
    key = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return U32.format(key=key)


def unit(*parts: str) -> str:
    return f"({u32(*parts)} / 4294967296.0)"


def split_case(key: str) -> str:
    b = f"({u32(key)} % 100)"
    return f"CASE WHEN {b} < 70 THEN 'train' WHEN {b} < 80 THEN 'val' ELSE 'test' END"


CASES = f"""
cases AS (
  SELECT d.doc_id AS case_id, {split_case('d.doc_id')} AS split, d.text AS report,
         CASE WHEN l.quality * 2 + l.toxic IS NOT NULL
              THEN 'class_' || CAST(l.quality * 2 + l.toxic AS VARCHAR) END AS label
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

CLINICAL = f"""
clinical AS (
  SELECT o.o_orderkey AS case_id, {split_case('o.o_orderkey')} AS split,
         c.c_mktsegment, o.o_orderpriority, c.c_acctbal, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

ABSENT = (0.0, 0.15, 0.30, 0.50)


def present(k: int, key: str = "vec_id") -> str:
    return f"{unit(repr(f'm{k}'), key)} >= {ABSENT[k]}"


RAD_LONG = f"""
rad_long AS (
  SELECT vec_id AS case_id, 'm' || CAST(m AS VARCHAR) AS modality,
         'rad_' || CAST(pos % 16 AS VARCHAR) AS feature, CAST(v AS DOUBLE) AS value
  FROM (SELECT vec_id, pos, v, pos // 16 AS m
        FROM (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings))
  WHERE (m = 0 AND {present(0)}) OR (m = 1 AND {present(1)})
     OR (m = 2 AND {present(2)}) OR (m = 3 AND {present(3)})
)"""

RAD_LABELS = f"""
rad_labels AS (
  SELECT vec_id AS case_id, {split_case('vec_id')} AS split,
         CASE WHEN label IS NOT NULL THEN 'class_' || CAST(label AS VARCHAR) END AS label
  FROM embeddings
)"""


def rad_wide(k: int) -> str:
    cols = ", ".join(f"CAST(embedding[{16 * k + i + 1}] AS DOUBLE) AS rad_{i}" for i in range(16))
    return f"m{k} AS (SELECT vec_id AS case_id, {cols} FROM embeddings WHERE {present(k)})"


PROBA = f"""
proba_raw AS (
  SELECT case_id, split, CAST(regexp_extract(label, '(\\d+)$', 1) AS INTEGER) AS y,
         [{unit("'p'", 'case_id', '0')}, {unit("'p'", 'case_id', '1')},
          {unit("'p'", 'case_id', '2')}, {unit("'p'", 'case_id', '3')}] AS raw
  FROM cases WHERE label IS NOT NULL
),
proba AS (
  SELECT case_id, split, y, list_transform(raw, lambda x: x / list_sum(raw)) AS p FROM proba_raw
)"""

WORD_RE = r"[\p{L}\p{N}_]+"
WORD2_RE = r"[\p{L}\p{N}_]{2,}"
DIGIT_RE = r"\p{Nd}"
PUNCT_RE = r"[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}]"
SPACE_RE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _key_text(key: str = "vec_id") -> str:
    u = unit("'key'", key)
    v = f"CAST({key} AS VARCHAR)"
    return f"CASE WHEN {u} < 0.02 THEN 'x' || {v} WHEN {u} < 0.10 THEN {v} || '.0' ELSE {v} END"


def mod_raw(k: int) -> str:
    rad = ", ".join(f"CAST(embedding[{16 * k + i + 1}] AS DOUBLE) AS rad_{i}" for i in range(16))
    return (f"mr{k} AS (SELECT {_key_text()} AS case_id, CASE WHEN label % 2 = 0 THEN 'F' ELSE 'M' END AS sex, "
            f"label + 30 AS age, 'm{k}' AS modality, {rad} FROM embeddings WHERE {present(k)})")


def mod_clean(k: int) -> str:
    rad = ", ".join(f"rad_{i} AS m{k}__rad_{i}" for i in range(16))
    return (f"mc{k} AS (SELECT CAST(trunc(TRY_CAST(case_id AS DOUBLE)) AS BIGINT) AS case_id, {rad} "
            f"FROM mr{k} WHERE TRY_CAST(case_id AS DOUBLE) IS NOT NULL)")


RAD_MERGED = ",\n".join([mod_raw(k) for k in range(4)] + [mod_clean(k) for k in range(4)]) + """,
rad AS (SELECT * FROM mc0 FULL JOIN mc1 USING (case_id) FULL JOIN mc2 USING (case_id) FULL JOIN mc3 USING (case_id))"""

CASE_FRAME = CASES + ",\n" + RAD_MERGED + """,
frame AS (SELECT c.*, r.* EXCLUDE (case_id) FROM cases c LEFT JOIN rad r ON r.case_id = c.case_id)"""

RAD_FRAME = RAD_LABELS + ",\n" + RAD_MERGED + """,
rframe AS (SELECT l.*, r.* EXCLUDE (case_id) FROM rad_labels l LEFT JOIN rad r ON r.case_id = l.case_id)"""

RAD_COLS = [f"m{k}__rad_{i}" for k in range(4) for i in range(16)]


def unpivot(src: str, name: str = "feature", value: str = "value") -> str:
    """``src`` must be a table or CTE name."""
    return f"(SELECT * FROM {src} UNPIVOT INCLUDE NULLS ({value} FOR {name} IN (COLUMNS('__rad_'))))"


GRID = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.15, 1.2, 1.3, 1.35, 1.4, 1.5, 1.6, 1.65, 1.7, 1.8, 1.9, 2.0,
        2.1, 2.2, 2.25, 2.3, 2.4, 2.5, 2.6, 2.7, 2.75, 2.8, 2.9, 3.0)


def metrics_ctes(pred: str, group: str, focus: tuple[int, ...] = (1, 3)) -> str:
    """CTEs conf, pc, summ over a relation ``pred`` with columns (group, y, pred)."""
    n_focus = len(focus)
    flist = ", ".join(str(f) for f in focus)
    return f"""
conf AS (SELECT {group}, y, pred, count(*) AS n FROM {pred} GROUP BY ALL),
pc0 AS (SELECT {group}, cls, sum(t) AS support, sum(tp) AS tp, sum(pp) AS predicted FROM (
          SELECT {group}, y AS cls, n AS t, CASE WHEN y = pred THEN n ELSE 0 END AS tp, 0 AS pp FROM conf
          UNION ALL SELECT {group}, pred AS cls, 0 AS t, 0 AS tp, n AS pp FROM conf) GROUP BY ALL),
pc AS (SELECT {group}, cls, tp, support, predicted,
              CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
              CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0.0 END AS f1
       FROM pc0),
summ AS (SELECT {group}, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1,
                sum(f1 * support) / sum(support) AS weighted_f1,
                sum(CASE WHEN cls IN ({flist}) THEN recall ELSE 0.0 END) / {n_focus} AS focus_recall
         FROM pc GROUP BY {group}),
score AS (SELECT *, accuracy AS micro_f1, 0.45 * accuracy + 0.35 * weighted_f1 + 0.20 * focus_recall AS blend FROM summ)"""
