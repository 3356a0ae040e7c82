"""Stand-in inputs built from the driver's parquet tables.

The pipeline's native inputs (case JSON, clinical CSV, per-modality radiomics
CSVs, image vectors) are replaced by rows of the same *schema* drawn from the
read-only fixture tables; see FIXTURES.md section 3. These builders only
reshape and rename - all pipeline work happens in the operators.

* cases      : documents LEFT JOIN labels; class = quality*2 + toxic
* clinical   : orders JOIN customer (categorical + numeric columns)
* radiomics  : embeddings cut into four 16-wide blocks, one per modality,
               each modality present for an md5-chosen share of cases
* proba      : md5-derived normalised class scores per case
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabtext.functions.hashing import hash_split, md5_unit

N_MODALITIES = 4
BLOCK = 16
# Fixed stand-in parameters (FIXTURES.md section 3): share of cases *absent*
# per modality block m0..m3.
MODALITY_ABSENT_SHARE = (0.0, 0.15, 0.30, 0.50)
FOCUS_CLASSES = ("class_1", "class_3", "class_9")  # class_9 never occurs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give row-heavy text work at least one partition per core. A large
    input already has more file splits than cores and is left alone (no
    shuffle); a small single-file table is redistributed round-robin."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def class_name(code: F.Column) -> F.Column:
    return F.when(code.isNotNull(), F.concat(F.lit("class_"), code.cast("string")))


def cases(spark: SparkSession, sf_dir: str, with_label: bool = True) -> DataFrame:
    """(case_id, split, report, label): one row per document.

    ``with_label=False`` skips the labels join (label is null) for text-only
    work, so a large labels table can never cause a shuffle of the texts."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    if not with_label:
        return d.select(F.col("doc_id").alias("case_id"), hash_split(F.col("doc_id")).alias("split"),
                        F.col("text").alias("report"), F.lit(None).cast("string").alias("label"))
    lab = table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("code"))
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("case_id"),
        hash_split(F.col("doc_id")).alias("split"),
        F.col("text").alias("report"),
        class_name(F.col("code")).alias("label"),
    )


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, label) of the labelled documents, for joins to rows that carry no text."""
    code = F.col("quality") * 2 + F.col("toxic")
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("case_id"), class_name(code).alias("label"))


def clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clinical-style table: one row per order with customer attributes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("o_orderkey").alias("case_id"),
        hash_split(F.col("o_orderkey")).alias("split"),
        "c_mktsegment", "o_orderpriority", "c_acctbal", "o_totalprice",
    )


def _present(modality: int) -> F.Column:
    return md5_unit(F.lit(f"m{modality}"), F.col("vec_id")) >= F.lit(MODALITY_ABSENT_SHARE[modality])


def radiomics_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, split, label) for the radiomics cases."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("case_id"),
                    hash_split(F.col("vec_id")).alias("split"),
                    class_name(F.col("label")).alias("label"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, vec array<double>) dense vector table."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def proba(spark: SparkSession, sf_dir: str, n_classes: int = 4, labelled_only: bool = True) -> DataFrame:
    """(case_id, split, y, p): md5-derived class scores summing to 1.

    ``y`` is the integer class code (null when unlabelled); ``p`` an array of
    ``n_classes`` doubles.
    """
    c = cases(spark, sf_dir)
    if labelled_only:
        c = c.filter(F.col("label").isNotNull())
    raw = F.array(*[md5_unit(F.lit("p"), F.col("case_id"), F.lit(k)) for k in range(n_classes)])
    x = c.select("case_id", "split", "label", raw.alias("_raw"))
    total = F.aggregate("_raw", F.lit(0.0), lambda a, v: a + v)
    return x.select(
        "case_id", "split",
        F.regexp_extract("label", r"(\d+)$", 1).cast("int").alias("y"),
        F.transform("_raw", lambda v: v / total).alias("p"),
    )


def radiomics_raw(spark: SparkSession, sf_dir: str, modality: int) -> DataFrame:
    """CSV-shaped modality frame as a reader would return it: text case_id
    (some written as '12.0', a few not numbers), sex, age, modality and
    numeric rad_0..rad_15."""
    e = table(spark, sf_dir, "embeddings").filter(_present(modality))
    u = md5_unit(F.lit("key"), F.col("vec_id"))
    vid = F.col("vec_id").cast("string")
    key = (F.when(u < 0.02, F.concat(F.lit("x"), vid))
           .when(u < 0.10, F.concat(vid, F.lit(".0"))).otherwise(vid))
    return e.select(
        key.alias("case_id"),
        F.when(F.col("label") % 2 == 0, "F").otherwise("M").alias("sex"),
        (F.col("label") + 30).alias("age"),
        F.lit(f"m{modality}").alias("modality"),
        *[F.col("embedding")[modality * BLOCK + i].cast("double").alias(f"rad_{i}") for i in range(BLOCK)],
    )


def case_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON case-map text per document: ``{"<doc_id>": {record}}``; report is
    a string, or an object with / without ``finding`` (md5-chosen)."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    lab = table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("code"))
    x = d.join(lab, "doc_id", "left")
    u = md5_unit(F.lit("r"), F.col("doc_id"))
    modalities = F.array_compact(F.array("lang", "source"))
    plain = F.to_json(F.create_map(F.col("doc_id").cast("string"),
                                   F.struct(F.col("text").alias("report"),
                                            modalities.alias("available_modalities"),
                                            class_name(F.col("code")).alias("Overall_class"))))
    finding = F.to_json(F.create_map(F.col("doc_id").cast("string"),
                                     F.struct(F.struct(F.col("text").alias("finding")).alias("report"),
                                              modalities.alias("available_modalities"),
                                              class_name(F.col("code")).alias("Overall_class"))))
    other = F.to_json(F.create_map(F.col("doc_id").cast("string"),
                                   F.struct(F.struct(F.col("text").alias("impression")).alias("report"),
                                            class_name(F.col("code")).alias("Overall_class"))))
    js = F.when(u < 0.1, other).when(u < 0.5, finding).otherwise(plain)
    return x.select("doc_id", plain.alias("js_plain"), js.alias("js_mixed"))
