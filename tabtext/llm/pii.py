"""Personal data: fixed patterns, plus terms that disclose their owner by corpus co-occurrence.

Base spans: leftmost non-overlapping email, ip, card and phone matches of each whole text, each kind on its
own, with the checks of ``_valid``. Every distinct valid value (lower-cased; digits only for card and phone)
is a protected entity.

Information-theoretic sanitisation: a term (a lower-cased word with a letter, outside every base span) and an
entity co-occur in a document that has both, wherever they stand. With N documents and document counts n, the
term discloses the entity to the degree PMI / IC = log2(N * n(t,c) / (n(t) * n(c))) / log2(N / n(c)); it is 1
if the term stands nowhere but with the entity, and 0 if it is as frequent everywhere; an entity of all documents
carries no information and has no terms. All counts are over all documents, and no number of joint documents is
asked for (``SUPPORT``): an entity of a single document is disclosed by each word that hardly stands elsewhere.
A term's degree is its largest over all entities. It is generalised to ``[WORD]`` from degree ``GENERALISE`` and
removed from degree ``REMOVE`` at each of its places in all documents, also those without base spans.

A pair reaches degree g only if n(t) <= N * (n(c) / N) ** g, so common terms leave before pairs are made. Entities
of the same documents have the same degrees and are counted as one (their rows' hashes, 128 bits, tell), so a
document with thousands of entities gives no more pairs than one.

DataFrame functions only. Positions are code points: the pieces between matches come from ``split`` and the
matches from ``regexp_extract_all`` with one pattern, so running lengths place every match; the sums go by
groups of ``GROUP``, so thousands of matches in one text stay cheap. The patterns are written without repeated
groups, which Java's engine follows by recursion and would overflow on in long texts: separators that stand
between two digits, and dots between two label characters, are first turned into private-use characters
of the same length, so that plain character classes express the repetition.

Null and empty texts have no spans; a text's own private-use characters are read as any other symbol. A
scan's rows are numbered and their narrow results written once, so rows need no id; repeated rows are
treated alike, null ids stay null, extra columns are ignored. For the terms' places a text is cut between words
into pieces of about ``PIECE`` code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabtext.session import cut_lineage, written

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 1
GENERALISE = 0.75
REMOVE = 0.9
GROUP = 64
PIECE = 48
COMMON = 1000
BITS = 1 << 27  # of the bitmap of disclosing terms that goes to every task: 16 MB at most
CHUNK = 1 << 15  # bits to a row of it
SEP, HYPHEN, DOT = "\ue000", "\ue001", "\ue002"  # a space or hyphen between digits, a dot between labels

_LOCAL = f"[A-Za-z0-9._%+{DOT}{HYPHEN}-]"
_LABEL = f"[A-Za-z0-9{HYPHEN}-]"
#: on the marked text; equal to the contract's patterns on the text itself
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}+@{_LABEL}+{DOT}[A-Za-z0-9{DOT}{HYPHEN}-]*",
    "ip": rf"(?<![0-9])[0-9]+[.{DOT}][0-9]+[.{DOT}][0-9]+[.{DOT}][0-9]+",
    "card": f"[0-9][0-9{SEP}{HYPHEN}]+",
    "phone": rf"\+[0-9][\x20().0-9{SEP}{HYPHEN}{DOT}-]+[0-9]",
}
_PART = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
WORD = r"[\p{L}\p{M}\p{N}_]+"


def marked(text: Column) -> Column:
    """The text with the separators the patterns count on turned into private-use characters, length kept."""
    t = F.translate(F.coalesce(text, F.lit("")), SEP + HYPHEN + DOT, 3 * "\ufffd")
    t = F.regexp_replace(t, r"(?<=[0-9])\x20(?=[0-9])", SEP)
    t = F.regexp_replace(t, r"(?<=[0-9])-(?=[0-9])", HYPHEN)
    return F.regexp_replace(t, rf"(?<=[A-Za-z0-9{HYPHEN}-])\.(?=[A-Za-z0-9{HYPHEN}-])", DOT)


def plain(value: Column) -> Column:
    return F.translate(value, SEP + HYPHEN + DOT, " -.")


def place(text: Column, pattern: str) -> tuple[Column, Column]:
    """(matches, gaps): the matched strings, and the lengths of the text in front of each since the last."""
    return (F.regexp_extract_all(text, F.lit(pattern), 0),
            F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x)))


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _group(i: Column) -> Column:
    return F.floor(i / GROUP).cast("int")


def group_sums(step: str) -> Column:
    """Sums of each GROUP consecutive lengths."""
    return F.transform(F.sequence(F.lit(0), _group(F.greatest(F.size(step) - 1, F.lit(0)))),
                       lambda g: _total(F.slice(step, g * GROUP + 1, F.lit(GROUP))))


def sum_before(step: str, groups: str, i: Column) -> Column:
    """Sum of the lengths in front of the i-th: whole groups, then the rest of its group."""
    return _total(F.slice(groups, F.lit(1), _group(i))) + _total(F.slice(step, _group(i) * GROUP + 1, i % GROUP))


def with_starts(d: DataFrame, kind: str) -> DataFrame:
    """Column a_: 0-based start of each match. Every array that a lambda reads is a column of its own and read
    twice, so that the planner does not compute it anew inside the lambda."""
    m, g, s, t = (x + kind for x in ("m_", "g_", "s_", "t_"))
    none = F.array().cast("array<int>")
    d = d.withColumn(s, F.when((F.size(g) > 0) & (F.size(m) > 0), F.transform(m, lambda x, i: F.char_length(x) + F.get(g, i))).otherwise(none))
    d = d.withColumn(t, group_sums(s))
    return d.withColumn("a_" + kind, F.when((F.size(t) > 0) & (F.size(s) > 0) & (F.size(g) > 0), F.transform(
        m, lambda x, i: sum_before(s, t, i) + F.get(g, i))).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        d = _digits(value)
        return F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), F.call_function("luhn_check", d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _entities(kind: str) -> Column:
    """The kind's spans as (a, z, entity)."""
    body = _digits if kind in ("card", "phone") else F.lower
    return F.transform(kind, lambda s: F.struct(s["a"].alias("a"), s["z"].alias("z"),
                                                F.concat(F.lit(kind + ":"), body(s["value"])).alias("entity")))


def _valid_spans(kind: str) -> Column:
    at = F.col("a_" + kind)
    spans = F.transform("m_" + kind, lambda x, i: F.struct(
        F.get(at, i).alias("a"), (F.get(at, i) + F.char_length(x)).alias("z"), plain(x).alias("value")))
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def base_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null as empty), and for each kind an array of (a, z, value) of its valid matches."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # only texts with a digit or an at sign are looked through
    some = F.col("text").contains("@") | F.col("text").rlike("[0-9]")
    d = d.withColumn("t", F.when(some, marked(F.col("text"))).otherwise(F.lit("")))
    for k in KINDS:
        m, g = place(F.col("t"), PATTERNS[k])
        d = d.withColumn("m_" + k, m)
        d = d.withColumn("g_" + k, F.when(F.size("m_" + k) > 0, g).otherwise(F.array().cast("array<int>")))
    for k in KINDS:
        d = with_starts(d, k)
    for k in KINDS:
        d = d.withColumn(k, _valid_spans(k))
    return d.select("doc_id", "text", *KINDS)


def _labelled(kind: str, value) -> Column:
    """The kind's spans as (a, z, by)."""
    return F.transform(kind, lambda s: F.struct(s["a"].alias("a"), s["z"].alias("z"), value(s).alias("by")))


def _scan(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One numbered row per document: its text and base spans, written once; ``every``: all spans with entities."""
    d = base_spans(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    return written(d.select("row", "doc_id", *KINDS, "text")).withColumn("every", F.concat(*[_entities(k) for k in KINDS]))


def _terms(scan: DataFrame) -> DataFrame:
    """(row, term, a, z) of every word with a letter that touches no base span. Arrays that a lambda reads are
    columns read twice, so that the planner does not put their expressions into the lambda."""
    p = scan.select("row", "every", F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{PIECE}}}{WORD[:-1]}*+"), 0).alias("pieces"))
    p = p.withColumn("step", F.transform("pieces", F.char_length))
    p = p.withColumn("groups", group_sums("step"))
    p = p.withColumn("at", F.when(F.size("groups") > 0, F.transform("pieces", lambda x, i: sum_before("step", "groups", i))))
    p = p.select("row", "every", F.explode(F.arrays_zip("at", "pieces")).alias("p")) \
        .select("row", "every", F.col("p.at").alias("at"), F.col("p.pieces").alias("piece"))
    z = F.col("at") + F.char_length("piece")
    near = F.when(F.size("every") > 0, F.filter("every", lambda s: (s["a"] < z) & (s["z"] > F.col("at")))).otherwise(F.col("every"))
    words, gaps = place(F.col("piece"), WORD)
    w = p.select("row", "at", near.alias("near"), words.alias("words"), gaps.alias("gaps"))
    w = w.withColumn("lengths", F.transform("words", F.char_length))
    begin = lambda i: F.col("at") + _total(F.slice("lengths", F.lit(1), i)) + _total(F.slice("gaps", F.lit(1), i + 1))
    w = w.withColumn("begin", F.when((F.size("gaps") > 0) & (F.size("lengths") >= 0), F.transform("words", lambda x, i: begin(i))))
    w = w.select("row", "near", F.explode(F.arrays_zip("begin", "words")).alias("w")) \
        .select("row", "near", F.col("w.words").alias("word"), F.col("w.begin").alias("a")) \
        .select("row", "near", F.lower("word").alias("term"), "a", (F.col("a") + F.char_length("word")).alias("z"))
    free = (F.size("near") == 0) | ~F.exists("near", lambda s: (s["a"] < F.col("z")) & (s["z"] > F.col("a")))
    return w.where(free & F.col("term").rlike(r"\p{L}")).select("row", "term", "a", "z")


def _limit(n: float, n_c: Column, degree: float) -> Column:
    """Documents that a term of an entity of ``n_c`` documents can have at most; a little more for rounding."""
    return F.lit(n) * F.pow(n_c / F.lit(n), F.lit(degree)) * (1 + 1e-9)


def disclosure(scan: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(term, degree) of terms at or above ``generalise``."""
    with_spans = F.size("every") > 0
    entities = scan.where(with_spans).select(
        "row", F.explode(F.array_distinct(F.transform("every", lambda s: s["entity"]))).alias("entity"))
    n = float(scan.count())
    hash_of = lambda k: F.bit_xor(F.xxhash64("row", F.lit(k)))
    by_entity = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"), hash_of(1).alias("x"), hash_of(2).alias("y")) \
        .where(F.col("n_c") < n)
    # entities of the same documents are one class
    classes = cut_lineage(entities.join(by_entity, "entity").select("row", "n_c", "x", "y").distinct())
    most = classes.agg(F.max("n_c")).first()[0]
    limit = max(1.0, n * ((most or 1) / max(n, 1.0)) ** generalise * (1 + 1e-9))
    inside = _terms(scan.where(with_spans)).select("row", "term").distinct()
    plain = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0))
    words = scan.where(~with_spans).select(F.explode(plain).alias("term")).where(F.col("term").rlike(r"\p{L}"))
    n_t = cut_lineage(words.unionByName(inside.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
                      .where((F.col("n_t") > n / COMMON) | (F.col("n_t") <= limit)))
    # terms too common for any entity of their document leave before the pairs are made
    largest = classes.groupBy("row").agg(F.max(_limit(n, F.col("n_c"), generalise)).alias("limit"))
    common = n_t.where((F.col("n_t") > limit) & (F.col("n_t") > n / COMMON)).select("term")
    rare = inside.join(F.broadcast(common), "term", "left_anti").join(n_t.where(F.col("n_t") <= limit), "term") \
        .join(largest, "row").where(F.col("n_t") <= F.col("limit")).select("row", "term", "n_t")
    pairs = rare.join(classes, "row").where(F.col("n_t") <= _limit(n, F.col("n_c"), generalise)) \
        .groupBy("n_c", "x", "y", "term", "n_t").agg(F.count(F.lit(1)).alias("n_tc")).where(F.col("n_tc") >= support)
    degree = F.log2(F.lit(n) * F.col("n_tc") / (F.col("n_t") * F.col("n_c"))) / F.log2(F.lit(n) / F.col("n_c"))
    found = pairs.groupBy("term").agg(F.max(degree).alias("degree")).where(F.col("degree") >= generalise)
    return cut_lineage(found)


def _bit() -> dict[str, Column]:
    """A term's place in the bitmap."""
    h = F.pmod(F.xxhash64("term"), F.lit(BITS))
    return {"chunk": F.floor(h / CHUNK).cast("int"), "bit": (h % CHUNK).cast("int")}


def _bitmap(terms: DataFrame) -> DataFrame:
    """One bit for the hash of each disclosing term, CHUNK to a row: words without a bit leave before they are moved."""
    return terms.withColumns(_bit()).groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))


def annotate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT,
             generalise: float = GENERALISE, with_text: bool = False) -> DataFrame:
    """row, doc_id, an array of spans for each kind, and ``term``: (a, z, degree) of disclosing terms."""
    scan = _scan(docs, doc_id, text)
    terms = disclosure(scan, support, generalise)
    places = _terms(scan).withColumns(_bit()).join(F.broadcast(_bitmap(terms)), "chunk")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    places = places.where(F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)).cast("int") % 2 == 1).select("row", "term", "a", "z")
    found = places.join(terms, "term") \
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("a", "z", "degree"))).alias("term"))
    return scan.join(found, "row", "left").select("row", "doc_id", *KINDS, "term", *(["text"] if with_text else []))


def _listed(kind: str) -> Column:
    spans = F.transform(kind, lambda s: F.concat(F.lit(kind + ":"), s["a"].cast("string"), F.lit(":"), s["z"].cast("string")))
    return F.coalesce(spans, F.array().cast("array<string>"))


def _listing(kinds) -> Column:
    return F.array_join(F.concat(*[_listed(k) for k in kinds]), ",")


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, terms last."""
    a = annotate(docs, doc_id, text)
    return a.select("doc_id", *[F.size(k).cast("bigint").alias("n_" + k) for k in KINDS],
                    F.sha2(_listing(KINDS), 256).alias("base_sha256"), _listing([*KINDS, "term"]).alias("spans"))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", remove: float = REMOVE) -> DataFrame:
    """doc_id and the text with base spans replaced by their kind, terms generalised or removed. Spans that
    overlap are replaced as one, by the kind that begins first."""
    a = annotate(docs, doc_id, text, with_text=True)
    kind = "array<struct<a:int,z:int,by:string>>"
    spans = [_labelled(k, lambda s, k=k: F.lit(f"[{k.upper()}]")) for k in KINDS]
    spans.append(F.coalesce(_labelled("term", lambda s: F.when(s["degree"] >= remove, F.lit("")).otherwise(F.lit("[WORD]"))),
                            F.array().cast(kind)))
    merged = F.aggregate(F.sort_array(F.concat(*spans)), F.array().cast(kind), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["z"] > s["a"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["z"], s["z"]).alias("z"),
            F.element_at(acc, -1)["by"].alias("by"))))).otherwise(F.concat(acc, F.array(s))))
    a = a.withColumn("merged", merged)
    body = F.transform("merged", lambda s, i: F.concat(
        F.substring(F.col("text"), F.coalesce(F.get("merged", i - 1)["z"], F.lit(0)) + 1,
                    s["a"] - F.coalesce(F.get("merged", i - 1)["z"], F.lit(0))), s["by"]))
    tail = F.substring(F.col("text"), F.element_at("merged", -1)["z"] + 1, F.char_length("text"))
    return a.select("doc_id", F.when(F.size("merged") > 0, F.concat(F.array_join(body, ""), tail))
                    .otherwise(F.col("text")).alias("text"))
