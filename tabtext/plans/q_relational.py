"""Queries over ingest, schema and join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabtext.operators import joins as J
from tabtext.operators import schema as P
from tabtext.plans import frames as FR
from tabtext.plans import sql as S
from tabtext.plans.registry import query
from tabtext.sources import cases as C
from tabtext.sources import files as FS
from tabtext.sources import standins as si

# ------------------------------------------------------------ case JSON ----

_JSON_PLAIN_SQL = """
SELECT d.doc_id AS case_id,
       CASE WHEN l.quality * 2 + l.toxic IS NOT NULL THEN 'class_' || CAST(l.quality * 2 + l.toxic AS VARCHAR) END
         AS Overall_class,
       coalesce(d.text, '') AS report,
       CAST((d.lang IS NOT NULL)::INTEGER + (d.source IS NOT NULL)::INTEGER AS INTEGER) AS n_modalities
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


@query("json_map_explode", _JSON_PLAIN_SQL)
def json_map_explode(spark, sf_dir):
    """JSON case maps -> rows with defaults (report '', label null,
    modalities []); round trip of maps built from the documents."""
    return C.explode_case_map(si.case_maps(spark, sf_dir), "js_plain")


@query("json_report_unwrap", f"""
SELECT d.doc_id AS case_id,
       CASE WHEN l.quality * 2 + l.toxic IS NOT NULL THEN 'class_' || CAST(l.quality * 2 + l.toxic AS VARCHAR) END
         AS Overall_class,
       CASE WHEN {S.unit("'r'", 'd.doc_id')} < 0.1 THEN '' ELSE coalesce(d.text, '') END AS report
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def json_report_unwrap(spark, sf_dir):
    """S3: report given as a string, as {finding: ...} or as an object without
    finding ('')."""
    return C.explode_case_map(si.case_maps(spark, sf_dir), "js_mixed", unwrap_finding=True,
                              with_modalities=False)


@query("array_len", """
SELECT doc_id AS case_id,
       CAST((lang IS NOT NULL)::INTEGER + (source IS NOT NULL)::INTEGER AS INTEGER) AS n_modalities
FROM documents""")
def array_len(spark, sf_dir):
    """Number of available modalities per case (absent list -> 0)."""
    return C.explode_case_map(si.case_maps(spark, sf_dir), "js_plain").select("case_id", "n_modalities")


# ------------------------------------------------------ schema operators ----

_RAD = ", ".join(f"rad_{i}" for i in range(16))


_RAW = [S.mod_raw(k) for k in range(4)]


def _raw_sql(select: str, where: str = "") -> str:
    """One SELECT over each modality's raw table, stacked."""
    return S.with_(*_RAW) + "\n" + "\nUNION ALL ".join(f"SELECT 'm{k}' AS file, {select} FROM mr{k}{where}" for k in range(4))


def _raw(spark, sf_dir, body):
    """``body`` applied to every modality's raw table, stacked with the file's name."""
    parts = [body(si.radiomics_raw(spark, sf_dir, k)).select(F.lit(f"m{k}").alias("file"), "*") for k in range(si.N_MODALITIES)]
    return P.union_splits(parts)


@query("prefix_project", _raw_sql(f"case_id, {_RAD}"))
def prefix_project(spark, sf_dir):
    """Key + columns named rad_* of every modality file."""
    return _raw(spark, sf_dir, P.prefix_project)


@query("drop_if_present", _raw_sql(f"case_id, sex, modality, {_RAD}"))
def drop_if_present(spark, sf_dir):
    """Exact-name drop of ['Sex', 'age', 'not_there'] from frames that
    hold both 'sex' and 'Sex' (only 'Sex' goes), every modality."""
    return _raw(spark, sf_dir, lambda raw: P.drop_exact(
        raw.select(*raw.columns, F.upper("sex").alias("Sex")), ["Sex", "age", "not_there"]))


@query("try_numeric", _raw_sql("""case_id AS case_id_text, TRY_CAST(case_id AS DOUBLE) AS case_id_num,
       CAST(trunc(TRY_CAST(case_id AS DOUBLE)) AS BIGINT) AS case_id_int"""))
def try_numeric(spark, sf_dir):
    """Text key -> double (bad text -> null), and -> bigint, whole
    numbers exact, fractions cut off; every modality."""
    return _raw(spark, sf_dir, lambda raw: raw.select(
        F.col("case_id").alias("case_id_text"), P.try_numeric("case_id").alias("case_id_num"),
        P.truncated_id("case_id").alias("case_id_int")))


@query("null_key_filter", _raw_sql("case_id AS case_id_text, CAST(trunc(TRY_CAST(case_id AS DOUBLE)) AS BIGINT) AS case_id",
                                   " WHERE TRY_CAST(case_id AS DOUBLE) IS NOT NULL"))
def null_key_filter(spark, sf_dir):
    """Rows whose numeric key is null are dropped, every modality."""
    return _raw(spark, sf_dir, lambda raw: raw.select(
        F.col("case_id").alias("case_id_text"), P.truncated_id("case_id").alias("case_id")).dropna(subset=["case_id"]))


@query("prefix_rename", S.with_(*_RAW, *[S.mod_clean(k) for k in range(4)]) + "\n" + "\nUNION ALL BY NAME ".join(
    f"SELECT * FROM mc{k}" for k in range(4)))
def prefix_rename(spark, sf_dir):
    """P4 (+P1, P3, P5-P7): every cleaned modality file, features renamed
    m<k>__rad_*, stacked by name."""
    parts = [FS.clean_modality_frame(si.radiomics_raw(spark, sf_dir, k), f"m{k}") for k in range(si.N_MODALITIES)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@query("label_mask", S.with_(S.CASES) + "\nSELECT case_id, split, label FROM cases WHERE label IS NOT NULL")
def label_mask(spark, sf_dir):
    """Labelled rows."""
    return P.label_mask(si.cases(spark, sf_dir)).select("case_id", "split", "label")


@query("split_filter", S.with_(S.CASES) + "\nSELECT case_id, label FROM cases WHERE split = 'val'")
def split_filter(spark, sf_dir):
    """The validation rows of the stacked frame."""
    return P.split_filter(si.cases(spark, sf_dir), "val").select("case_id", "label")


@query("union_splits", S.with_(S.CASES) + "\nSELECT case_id, split, label FROM cases")
def union_splits(spark, sf_dir):
    """Per-split frames stacked back by column name."""
    c = si.cases(spark, sf_dir).select("case_id", "split", "label")
    parts = [c.filter(F.col("split") == s) for s in ("train", "val", "test")]
    return P.union_splits(parts)


_M01 = [c for c in S.RAD_COLS if c.startswith(("m0", "m1"))]
_M0 = [c for c in S.RAD_COLS if c.startswith("m0")]


def _align_sql() -> str:
    def cols(have):
        return ", ".join(c if c in have else f"CAST(NULL AS DOUBLE) AS {c}" for c in S.RAD_COLS)
    return S.with_(S.CASE_FRAME) + f"""
SELECT case_id, label, {cols(set(S.RAD_COLS))}, 'train' AS split FROM frame WHERE split = 'train'
UNION ALL SELECT case_id, label, {cols(set(_M01))}, 'val' FROM frame WHERE split = 'val'
UNION ALL SELECT case_id, CAST(NULL AS VARCHAR), {cols(set(_M0))}, 'test' FROM frame WHERE split = 'test'"""


@query("align_union", _align_sql())
def align_union(spark, sf_dir):
    """P10: val has only m0/m1 features plus an extra column, test only m0
    and no label; stacked under the train schema (missing -> null, extra
    dropped)."""
    fr = FR.case_frame(spark, sf_dir).drop("report")
    train = fr.filter("split = 'train'").select("case_id", "label", *FR.RAD_COLS)
    val = fr.filter("split = 'val'").select("case_id", "label", *_M01, F.lit(1).alias("val_only"))
    test = fr.filter("split = 'test'").select("case_id", *_M0)
    return P.align_union({"train": train, "val": val, "test": test})


# ----------------------------------------------------------------- joins ----

@query("join_clinical_left", S.with_(S.CASES, S.CLINICAL) + """
SELECT k.case_id, k.split, k.c_mktsegment, k.o_orderpriority, k.c_acctbal, k.o_totalprice,
       c.label, CAST(length(c.report) AS BIGINT) AS report_len
FROM clinical k LEFT JOIN cases c ON c.case_id = k.case_id""")
def join_clinical_left(spark, sf_dir):
    """Clinical LEFT JOIN case rows (cases without a clinical row are
    lost, clinical rows without a case keep null report/label)."""
    cases = si.cases(spark, sf_dir, with_label=False) \
        .select("case_id", F.char_length("report").cast("bigint").alias("report_len")) \
        .join(si.labels_of(spark, sf_dir), "case_id", "left")
    j = J.join_clinical(si.clinical(spark, sf_dir), cases)
    return j.select("case_id", "split", "c_mktsegment", "o_orderpriority", "c_acctbal", "o_totalprice",
                    "label", "report_len")


_RAD_SQL = S.with_(S.RAD_MERGED) + "\nSELECT * FROM rad"


@query("join_modalities_full", _RAD_SQL)
def join_modalities_full(spark, sf_dir):
    """Chained FULL OUTER joins of the four modality frames."""
    return J.merge_modalities(FR.modality_frames(spark, sf_dir), how="full", strategy="join")


@query("modalities_pivot", _RAD_SQL)
def modalities_pivot(spark, sf_dir):
    """J2 as one shuffle: union + groupBy(case_id) (keys unique per file)."""
    frames = FR.modality_frames(spark, sf_dir)
    return J.merge_modalities(frames, how="full", strategy="union")


@query("join_radiomics_left", S.with_(S.CASE_FRAME) + "\nSELECT * EXCLUDE (report) FROM frame")
def join_radiomics_left(spark, sf_dir):
    """Cases LEFT JOIN merged radiomics."""
    return FR.case_frame(spark, sf_dir).drop("report")


@query("vector_lookup_zero", S.with_(S.CASES) + """
SELECT case_id, CAST(pos AS INTEGER) AS pos, value FROM (
  SELECT c.case_id, unnest(range(0, 64)) AS pos,
         unnest(coalesce(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)),
                         list_transform(range(0, 64), lambda i: 0.0))) AS value
  FROM cases c LEFT JOIN embeddings e ON e.vec_id = c.case_id)""")
def vector_lookup_zero(spark, sf_dir):
    """Vector per case by key, zeros(64) when absent (long form)."""
    v = J.lookup_vector(si.cases(spark, sf_dir).select("case_id"), si.vectors(spark, sf_dir), 64)
    return v.select("case_id", F.posexplode("vec").alias("pos", "value"))


def _vec_concat_sql() -> str:
    blocks = []
    for k in range(4):
        blocks.append(f"v{k} AS (SELECT vec_id, list_transform(embedding[{16 * k + 1}:{16 * k + 16}], "
                      f"lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE {S.present(k)})")
    zero = "list_transform(range(0, 16), lambda i: 0.0)"
    joined = " ".join(f"LEFT JOIN v{k} ON v{k}.vec_id = c.case_id" for k in range(4))
    cat = " || ".join(f"coalesce(v{k}.v, {zero})" for k in range(4))
    return S.with_(S.CASES, *blocks) + f"""
SELECT case_id, CAST(pos AS INTEGER) AS pos, value FROM (
  SELECT c.case_id, unnest(range(0, 64)) AS pos, unnest({cat}) AS value FROM cases c {joined})"""


@query("vector_concat", _vec_concat_sql())
def vector_concat(spark, sf_dir):
    """One 16-wide vector per modality (zeros when absent), concatenated
    in modality order (long form)."""
    e = si.table(spark, sf_dir, "embeddings")
    blocks = []
    for k in range(si.N_MODALITIES):
        vk = e.filter(si._present(k)).select(
            F.col("vec_id").alias("case_id"),
            F.transform(F.slice("embedding", k * si.BLOCK + 1, si.BLOCK), lambda x: x.cast("double")).alias("vec"))
        blocks.append((f"m{k}", vk))
    out = J.concat_vectors(si.cases(spark, sf_dir).select("case_id"), blocks, si.BLOCK)
    return out.select("case_id", F.posexplode("vec").alias("pos", "value"))


@query("submission", S.with_(S.CASES, f"""
sc AS (SELECT case_id, split, [{S.unit("'p'", 'case_id', '0')}, {S.unit("'p'", 'case_id', '1')},
                               {S.unit("'p'", 'case_id', '2')}, {S.unit("'p'", 'case_id', '3')}] AS p FROM cases)""") + """
SELECT CAST(case_id AS VARCHAR) AS case_id, 'class_' || CAST(list_position(p, list_max(p)) - 1 AS VARCHAR) AS Overall_class
FROM sc WHERE split = 'test'""")
def submission(spark, sf_dir):
    """Test cases with the arg-max class of their scores, key as text."""
    p = si.proba(spark, sf_dir, labelled_only=False).filter("split = 'test'")
    pred = F.concat(F.lit("class_"), (F.array_position("p", F.array_max("p")) - 1).cast("string"))
    return FS.submission(p.withColumn("pred", pred))
