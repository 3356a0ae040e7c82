"""Word and char_wb n-gram generators as higher-order array expressions.

* word n-grams: tokens are runs of at least two word characters of the
  lower-cased text, n-grams join consecutive tokens with one space.
* char_wb n-grams: the text is split on whitespace, each word is padded with
  one space on both sides, and n-grams are taken inside the padded word for n
  in [n_min, n_max]; a padded word not longer than n contributes itself once
  and longer n are skipped.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabtext.functions.text import SPACE_CLASS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import the package

HELD_WORDS = 100_000  # distinct words whose n-grams a task holds at once
HELD_GRAMS = 1 << 20  # n-grams of texts that a task sorts at once
HELD_TOKENS = 1 << 20  # word tokens a task counts at once
WORD2 = r"[\p{L}\p{N}_]{2,}"


def word_tokens(text: Column, lower: bool = True) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.regexp_extract_all(F.lower(t) if lower else t, F.lit(WORD2), 0)


def _ngrams_of(toks: Column, n: int) -> Column:
    """n-grams of a *materialised* token column (a column reference, so the
    lambda below does not re-evaluate the tokenizer per element)."""
    if n == 1:
        return toks
    # i is the 1-based start position; slice(toks, i, n) is always in range.
    return F.when(
        F.size(toks) >= n,
        F.transform(F.sequence(F.lit(1), F.size(toks) - (n - 1)),
                    lambda i: F.array_join(F.slice(toks, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def with_word_ngrams(df: DataFrame, text: str, out: str, n_min: int = 1, n_max: int = 2,
                     lower: bool = True) -> DataFrame:
    """Adds ``out``: all word n-grams of ``text`` for n in [n_min, n_max] (V2)."""
    tmp = f"__{out}_tok"
    df = df.withColumn(tmp, word_tokens(F.col(text), lower))
    parts = [_ngrams_of(F.col(tmp), n) for n in range(n_min, n_max + 1)]
    return df.withColumn(out, parts[0] if len(parts) == 1 else F.concat(*parts)).drop(tmp)


def char_wb_ngrams(text: Column, n_min: int = 3, n_max: int = 5, lower: bool = True) -> Column:
    """All char_wb n-grams of ``text`` (V3)."""
    t = F.coalesce(text, F.lit(""))
    t = F.lower(t) if lower else t
    words = F.filter(F.split(t, f"[{SPACE_CLASS}]+"), lambda w: w != F.lit(""))
    ns = F.sequence(F.lit(n_min), F.lit(n_max))

    def grams(w: Column) -> Column:
        p = F.concat(F.lit(" "), w, F.lit(" "))
        length = F.char_length(p)
        keep = F.filter(ns, lambda n: (n == F.lit(n_min)) | (length >= n))
        return F.flatten(F.transform(
            keep,
            lambda n: F.transform(F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1))),
                                  lambda i: F.substring(p, i, n)),
        ))

    return F.flatten(F.transform(words, grams))


def with_term_counts(df: DataFrame, terms: str, out: str) -> DataFrame:
    """Adds ``out`` = array<struct<term string, n bigint>>: the distinct terms
    of each row with their counts.

    Sort + run-length inside the row, so per-document counting needs no
    shuffle however large the corpus is. Intermediate arrays are separate
    columns so the lambdas index materialised arrays (O(n log n) per row).
    """
    s, st = f"__{out}_s", f"__{out}_st"
    df = df.withColumn(s, F.sort_array(F.col(terms)))  # native ordering, no lambda comparator
    starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                      lambda i: (i == 0) | (F.get(F.col(s), i) != F.get(F.col(s), i - 1)))
    df = df.withColumn(st, F.when(F.size(s) > 0, starts).otherwise(F.array().cast("array<int>")))
    counts = F.transform(
        F.col(st),
        lambda p, j: F.struct(F.get(F.col(s), p).alias("term"),
                              (F.coalesce(F.get(F.col(st), j + 1), F.size(s)) - p).cast("bigint").alias("n")),
    )
    return df.withColumn(out, counts).drop(s, st)


def lowered(text: Column, lower: bool = True) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.lower(t) if lower else t


def grams_of_word(word: str, n_min: int, n_max: int) -> list[str]:
    """The char_wb n-grams of one word, with repeats."""
    p = f" {word} "
    return [p[i:i + n] for n in range(n_min, n_max + 1) if n == n_min or len(p) >= n for i in range(max(len(p) - n + 1, 1))]


def grams_of_words(words: Sequence[str], n_min: int, n_max: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct char_wb n-grams of some words, and of each word (n+1 offsets) the numbers of its n-grams, with repeats. Windows of all
    words are taken at once; a padded word has 3 characters at least, so with ``n_min`` 3 none is shorter than its windows."""
    if n_min != 3 or not len(words):
        number: dict[str, int] = {}
        ids = [[number.setdefault(g, len(number)) for g in grams_of_word(w, n_min, n_max)] for w in words]
        return list(number), np.cumsum([0, *map(len, ids)]), np.array([i for own in ids for i in own], np.int64)
    text = f" {' '.join(words)} "
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    used = np.zeros(0x110000, bool)
    used[c] = True
    ids, kinds = (np.cumsum(used) - 1)[c], int(used.sum())
    spaces = np.concatenate(([0], np.cumsum(c == 32)))  # before each place
    terms, of, numbers, code, size = [], [], [], ids, kinds
    for n in range(2, n_max + 1):
        if size * kinds >= 1 << 62:
            u, code = np.unique(code, return_inverse=True)
            size = len(u)
        code, size = code[:-1] * kinds + ids[n - 1:], size * kinds
        if n < n_min:
            continue
        at = np.flatnonzero(spaces[n - 1:len(c)] == spaces[1:len(c) - n + 2])  # no space but at the ends
        _, first, inv = np.unique(code[at], return_index=True, return_inverse=True)
        of.append((spaces[at + 1] - 1).astype(np.int32))
        numbers.append(inv + len(terms))
        terms += [text[i:i + n] for i in at[first].tolist()]
    of, numbers = np.concatenate(of), np.concatenate(numbers)
    return terms, np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(words))))), numbers[np.argsort(of, kind="stable")]


def word_chunks(texts: Iterable[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces of about ``HELD_WORDS`` distinct words: these words; n+1 offsets of the texts, numbers of the distinct words of each and
    how often it has them. ``str.split`` cuts at ``SPACE_CLASS``."""
    number: dict[str, int] = {}
    off, word, times = [0], [], []

    def out():
        return list(number), np.array(off), np.array(word, np.int64), np.array(times, np.int64)

    for t in texts:
        own = Counter(t.split())
        word += [number.setdefault(w, len(number)) for w in own]
        times += own.values()
        off.append(len(word))
        if len(number) >= HELD_WORDS or len(word) >= 8 * HELD_WORDS or len(off) > HELD_WORDS:
            yield out()
            number, off, word, times = {}, [0], [], []
    if len(off) > 1:
        yield out()


def gathered(off: np.ndarray, values: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of some numbers one after the other, and the length of each."""
    n = off[which + 1] - off[which]
    return values[np.arange(n.sum()) + np.repeat(off[which] - np.cumsum(n) + n, n)], n


def pieces_of(off: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose words have about ``HELD_GRAMS`` n-grams together."""
    ends, a = np.concatenate(([0], np.cumsum(size)))[off], 0
    while a < len(off) - 1:
        z = max(a + 1, int(np.searchsorted(ends, ends[a] + HELD_GRAMS, "right")) - 1)
        yield a, z
        a = z


def count_char_grams(df: DataFrame, text: str, n_min: int = 3, n_max: int = 5, lower: bool = True,
                     group: Sequence[str] = ()) -> DataFrame:
    """(group..., term, df, cf): rows that hold each char_wb n-gram and its occurrences. An n-gram belongs to one word, so a row is
    cut into its distinct words only; tasks add up their rows before terms are exchanged."""
    narrow = df.select(*group, lowered(F.col(text), lower).alias("_t"))
    schema = ", ".join([*(f"`{g}` {narrow.schema[g].dataType.simpleString()}" for g in group), "term string, df bigint, cf bigint"])
    names = [*group, "term", "df", "cf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []  # of the rows that wait
        kinds: list = []

        def texts() -> Iterator[str]:
            for b in batches:
                kinds[:] = [b.column(i).type for i in range(len(group))]
                own = zip(*(b.column(i).to_pylist() for i in range(len(group)))) if group else iter([()] * b.num_rows)
                for key, t in zip(own, b.column(len(group))):
                    keys.append(key)
                    yield t.as_py()

        for words, off, word, times in word_chunks(texts()):
            terms, ptr, grams = grams_of_words(words, n_min, n_max)
            number: dict[tuple, int] = {}
            g = np.array([number.setdefault(k, len(number)) for k in keys[:len(off) - 1]], np.int64)
            del keys[:len(off) - 1]
            size, all_terms = max(1, len(terms)), pa.array(terms, pa.string())
            rows = np.zeros((len(number), size), np.int64)
            for a, z in pieces_of(off, np.diff(ptr)[word]):
                own = slice(off[a], off[z])
                found, n = gathered(ptr, grams, word[own])
                pairs = np.repeat(np.repeat(np.arange(a, z), np.diff(off[a:z + 1])), n) * size + found
                pairs.sort()  # np.unique goes by hashes, which is far slower
                pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))[:len(pairs)]]
                rows += np.bincount(g[pairs // size] * size + pairs % size, minlength=rows.size).reshape(rows.shape)
            owner = np.repeat(g, np.diff(off))
            for key, i in number.items():
                seen = np.flatnonzero(rows[i])
                if len(seen):
                    mine = np.bincount(word[owner == i], times[owner == i], len(words))
                    total = np.bincount(grams, np.repeat(mine, np.diff(ptr)), size)[seen].astype(np.int64)
                    held = [pa.array([k] * len(seen), t) for k, t in zip(key, kinds)]
                    yield pa.RecordBatch.from_arrays([*held, all_terms.take(pa.array(seen)), pa.array(rows[i][seen]), pa.array(total)], names=names)

    parts = narrow.mapInArrow(run, schema)
    return parts.groupBy(*group, "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def count_word_grams(df: DataFrame, text: str, n_min: int = 1, n_max: int = 2, lower: bool = True,
                     group: Sequence[str] = ()) -> DataFrame:
    """(group..., term, df, cf): rows that hold each word 1- or 2-gram and its occurrences. Tokens are numbered in the tasks, which add up
    about ``HELD_TOKENS`` of them before terms are exchanged."""
    narrow = df.select(*group, word_tokens(F.col(text), lower).alias("_t"))
    schema = ", ".join([*(f"`{g}` {narrow.schema[g].dataType.simpleString()}" for g in group), "term string, df bigint, cf bigint"])
    names, most = [*group, "term", "df", "cf"], HELD_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(len(group))
            off = lists.offsets.to_numpy().astype(np.int64)
            flat, off, a = lists.flatten(), off - off[0], 0
            while a < b.num_rows:
                z = min(max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1), a + most, b.num_rows)
                tokens = flat.slice(off[a], off[z] - off[a]).dictionary_encode()
                ids, words, v = tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64), tokens.dictionary, max(1, len(tokens.dictionary))
                row = np.repeat(np.arange(z - a), np.diff(off[a:z + 1]))
                numbers: dict[tuple, int] = {}
                keys = zip(*(b.column(i).slice(a, z - a).to_pylist() for i in range(len(group)))) if group else [()] * (z - a)
                g = np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)
                for n in range(n_min, n_max + 1):
                    code, at, size = (ids, row, v) if n == 1 else (ids[:-1] * v + ids[1:], row[:-1], v * v)
                    if n == 2:  # of neighbours in one row
                        same = row[:-1] == row[1:]
                        code, at = code[same], at[same]
                    pairs, times = np.unique(at * size + code, return_counts=True)
                    terms, inv = np.unique(g[pairs // size] * size + pairs % size, return_inverse=True)
                    if not len(terms):
                        continue
                    own, term = terms // size, terms % size
                    text_of = words.take(pa.array(term)) if n == 1 else pc.binary_join_element_wise(words.take(pa.array(term // v)), words.take(pa.array(term % v)), " ")
                    held = [pa.array([k[i] for k in numbers], b.column(i).type).take(pa.array(own)) for i in range(len(group))]
                    sums = (np.bincount(inv, minlength=len(terms)), np.bincount(inv, times, len(terms)).astype(np.int64))
                    yield pa.RecordBatch.from_arrays([*held, text_of, *(pa.array(x, pa.int64()) for x in sums)], names=names)
                a = z

    parts = narrow.mapInArrow(run, schema)
    return parts.groupBy(*group, "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def char_gram_counts(text: Column, vocabulary: Sequence[str], n_min: int = 3, n_max: int = 5, lower: bool = True) -> Column:
    """Sparse ML vector of how often each char_wb n-gram of ``vocabulary`` occurs in a text."""
    place, size = {t: i for i, t in enumerate(vocabulary)}, len(vocabulary)

    @F.arrow_udf(VectorUDT())
    def run(texts: pa.Array) -> pa.Array:
        index, values, ends = [np.zeros(0, np.int32)], [np.zeros(0)], [np.zeros(1, np.int64)]
        for words, off, word, times in word_chunks(t.as_py() for t in texts):
            terms, ptr, grams = grams_of_words(words, n_min, n_max)
            at = np.array([place.get(g, -1) for g in terms], np.int64)[grams]
            known = np.concatenate(([0], np.cumsum(at >= 0)))[ptr]  # offsets of the n-grams in the vocabulary
            at = at[at >= 0]
            for a, z in pieces_of(off, np.maximum(np.diff(known)[word], 1)):
                own = slice(off[a], off[z])
                found, n = gathered(known, at, word[own])
                row = np.repeat(np.repeat(np.arange(z - a), np.diff(off[a:z + 1])), n)
                cells, inv = np.unique(row * size + found, return_inverse=True)
                index.append((cells % size).astype(np.int32))
                values.append(np.bincount(inv, np.repeat(times[own], n), len(cells)))
                ends.append(ends[-1][-1] + np.cumsum(np.bincount(cells // size, minlength=z - a)))
        ends = np.concatenate(ends)
        rows, ends = len(texts), pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(v))) for v in (index, values)]
        return pa.StructArray.from_arrays([pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, size, np.int32)), *lists],
                                          names=["type", "size", "indices", "values"])

    return run(lowered(text, lower))
