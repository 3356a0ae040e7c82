"""PII, language id, token counts, packing, HTML and decontamination against brute force and on odd input."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabtext.llm import decontam, html, langid, packing, pii, tokencount, tokens

SF0, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

ODD = [None, "", " \n\t", "a", "ä ß 漢字 \U0001F600", "word " * 3000, "x" * 30000, "1 " * 20000, "1-2-3.4.5.6@7.8-9.0",
       "a@b.c@d.e x@y.z_q@r.s.t", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.001", "+1 (555) 123-4567 ++49 30 1234567- x",
       "é4111-1111-1111-1111é \U0001F600 4111 1111 1111 1111", "a." * 9000 + "@b" + ".c" * 9000, "same text", "same text",
       "own  private  use 41111111 ab@cd"]


def odd_docs(spark):
    rows = [(None if i == 3 else i, t, None if i % 3 else "en", i) for i, t in enumerate(ODD)] + [(14, "same text", None, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, row bigint") \
        .withColumn("T", F.lit(1)).withColumn("_bench_hit", F.lit("x"))


def empty(spark, schema="doc_id bigint, text string, lang string, source string"):
    return spark.createDataFrame([], schema)


# fixed values: the contract's patterns
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "card" and not (13 <= len(d) <= 19 and luhn(d)) \
                    or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_pii_base_spans(spark, which):
    docs = odd_docs(spark) if which == "odd" else spark.read.parquet(f"{SF1}/documents.parquet")
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        s = base_spans(r.text)
        want[(r.doc_id, *[sum(x[0] == k for x in s) for k in BASE],
              hashlib.sha256(",".join("%s:%d:%d" % x for x in s).encode()).hexdigest())] += 1
    got = pii.detect(docs).collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want


def test_pii_many_matches_in_one_text(spark):
    """20,000 matches of each kind in a text: placed in linear time, as by brute force."""
    n = 20_000
    text = " ; ".join(f"u{i}@ex{i}.com 10.{i % 250}.{i // 250}.7 +1 555 {1000000 + i}, 4111 1111 1111 1111" for i in range(n))
    r = pii.base_spans(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    for kind in pii.KINDS:
        assert [(s.a, s.z) for s in r[kind]] == [(a, z) for k, a, z in base_spans(text) if k == kind] and len(r[kind]) >= n


def test_pii_disclosing_terms(spark):
    rows = [(i, f"contact marwick the boss mail x{i % 2}@corp.example.com or the desk") for i in range(6)]
    rows += [(10 + i, "the boss or the desk mail nobody") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = dict(rows)
    terms = {}
    for r in pii.detect(docs).collect():
        terms[r.doc_id] = {text[r.doc_id][int(a):int(z)] for a, z in re.findall(r"term:(\d+):(\d+)", r.spans)}
    n, want = len(rows), set()
    for w in ("contact", "marwick", "the", "boss", "mail", "or", "desk"):
        n_t, n_c, n_tc = sum(w in t.split() for t in text.values()), 3, 3
        if np.log2(n * n_tc / (n_t * n_c)) / np.log2(n / n_c) >= pii.GENERALISE:
            want.add(w)
    assert "marwick" in want and "the" not in want
    assert all(terms[i] == want for i in range(6)) and not any(terms[10 + i] for i in range(60))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "marwick" not in clean[0] and "[EMAIL]" in clean[0] and "the boss" in clean[0] and clean[10] == text[10]


def test_pii_terms_over_whole_documents(spark):
    """Names far from the address, in one document only, with digits, and in documents without a span."""
    far = " the desk" * 40
    rows = [(i, f"mail a@corp.example.com{far} Marwick jane_doe42 the") for i in range(2)]
    rows += [(2, f"mail b@corp.example.com{far} zorblat +1 (555) 123-4567")]
    rows += [(3, "of the marwick desk")]
    rows += [(10 + i, f"mail the desk number 42 nobody {i}") for i in range(60)]
    docs, text = spark.createDataFrame(rows, "doc_id bigint, text string"), dict(rows)
    n, got = len(rows), {}
    words = {d: set(re.findall(r"\w*[^\W\d]\w*", re.sub(r"\S+@\S+", " ", t).lower())) for d, t in rows}
    want = {d: set() for d in words}
    for owners in ({0, 1}, {2}):
        for w in set.union(*words.values()):
            n_t, n_tc = sum(w in x for x in words.values()), sum(w in words[d] for d in owners)
            if n_tc and np.log2(n * n_tc / (n_t * len(owners))) / np.log2(n / len(owners)) >= pii.GENERALISE:
                for d in words:
                    want[d] |= {w} & words[d]
    for r in pii.detect(docs).collect():
        got[r.doc_id] = {text[r.doc_id][int(a):int(z)].lower() for a, z in re.findall(r"term:(\d+):(\d+)", r.spans)}
    assert got == want and want[0] == {"marwick", "jane_doe42"} and want[2] == {"zorblat"} and want[3] == {"marwick"} and not want[10]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any(re.search("marwick|jane|zorblat", x, re.I) for x in clean.values())


def test_pii_equal_rows(spark):
    """An entity of all documents carries no information: its spans stay, and no term is its own."""
    docs = spark.createDataFrame([(i, "contact marwick mail x@corp.example.com") for i in range(4)], "doc_id bigint, text string")
    assert [(r.n_email, "term" in r.spans) for r in pii.detect(docs).collect()] == [(1, False)] * 4


def test_pii_empty(spark):
    assert pii.detect(empty(spark)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    r = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(x.lang_pred == x.lang for x in r) / len(r) > 0.98
    assert all(0 <= x.score <= 1 for x in r)


def test_language_odd_input(spark):
    docs = spark.read.parquet(f"{SF0}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    out, c = langid.annotate(odd_docs(spark), model)
    for r in out.collect():
        letters = bool(re.search(r"[^\W\d_]", r.text or ""))
        assert (r[c["lang_pred"]] == "und") == (not letters) and (letters or r[c["score"]] == 0)
    assert langid.identify(empty(spark)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_inputs(spark):
    """lang and doc_id decide nothing but who trains."""
    docs = spark.read.parquet(f"{SF0}/documents.parquet").select("doc_id", "text", "lang")
    held = docs.withColumn("lang", F.when(langid.remainder("doc_id") == 2, F.lit("xx")).otherwise(F.col("lang")))
    key = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify(df).collect())
    assert key(docs) == key(held)


@pytest.mark.parametrize("which,block", [("odd", 7), ("odd", 1 << 20), ("documents", 1000)])
def test_token_counts(spark, which, block):
    docs = odd_docs(spark) if which == "odd" else spark.read.parquet(f"{SF0}/documents.parquet")
    v = tokens.read()
    want = Counter((r.doc_id, len(v.encode(r.text))) for r in docs.collect())
    got = tokencount.document_tokens(docs.repartition(3), block=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want
    by_file = {}
    for r in got:
        by_file.setdefault(r.file, []).append((r.ordinal, r.token_start, r.n_tokens))
    for rows in by_file.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert all(a[1] + a[2] + 1 == b[1] for a, b in zip(rows, rows[1:]))


def test_token_counts_unended_document_and_empty_folder(spark, tmpdir_path):
    np.array([5, 9, 1, 9, 9, 2, 3], "<u2").tofile(f"{tmpdir_path}/tokens-000000.bin")
    for block in (1, 2, 100):
        got = sorted(map(tuple, tokencount.count_tokens(spark, tmpdir_path, 9, "<u2", block).collect()))
        assert got == [(0, 0, 0, 1), (0, 1, 2, 1), (0, 2, 4, 0), (0, 3, 5, 2)]
    assert tokencount.document_tokens(empty(spark)).count() == 0


def test_long_text_pieces(monkeypatch):
    v = tokens.read()
    text = "It's a long text, with words  and\n\nlines 123 ... of it's own. " * 200
    whole = v.encode(text)
    monkeypatch.setattr(tokens, "PIECE", 500)
    assert np.array_equal(tokens.read().encode(text), whole)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_packing_round_trip(spark, which):
    docs = odd_docs(spark) if which == "odd" else spark.read.parquet(f"{SF0}/documents.parquet")
    v, length = tokens.read(), 128
    rows = packing.pack(docs, length=length).collect()
    assert len({r.row_id for r in rows}) == len(rows)
    parts = []
    for r in rows:
        ids, pos, cu = np.frombuffer(bytes(r.input_ids), "<u2"), np.frombuffer(bytes(r.position_ids), "<u2"), r.cu_seqlens
        assert len(ids) == len(pos) == length and cu[0] == 0 and cu[-1] == r.n_tokens <= length
        assert (ids[r.n_tokens:] == v.eod).all()
        for d, p, a, z in zip(r.doc_ids, r.parts, cu, cu[1:]):
            assert (pos[a:z] == np.arange(z - a)).all()
            parts.append((d, p, tuple(ids[a:z])))
    whole = {}
    for d, p, x in parts:
        whole.setdefault((d, p), []).append(x)
    want = Counter((r.doc_id, tuple(np.append(v.encode(r.text), v.eod))[:length]) for r in docs.collect())
    assert Counter((d, x) for (d, p), xs in whole.items() if p == 0 for x in xs) == want
    assert sum(len(x) for _, _, x in parts) == sum(len(v.encode(r.text)) + 1 for r in docs.collect())
    assert packing.pack(empty(spark)).count() == 0


def test_best_fit_decreasing_against_scan():
    rng = np.random.default_rng(3)
    for _ in range(30):
        cap = int(rng.integers(1, 60))
        sizes = rng.integers(1, cap + 1, int(rng.integers(0, 80))).tolist()
        free, want = [], []
        for s in sorted(sizes, reverse=True):
            fits = [f for f in free if f >= s]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - s)
            else:
                free.append(cap - s)
        got = packing.best_fit_decreasing(sizes, cap)
        assert sorted(i for r in got for i in r) == list(range(len(sizes)))
        assert sorted(cap - sum(sizes[i] for i in r) for r in got) == sorted(free)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<div id="cookie-banner">We use cookies</div><header><h2>Site</h2></header><nav><a href=/>Home</a></nav>
%s<h1>Big  &amp; small</h1><p>First <b>bold</b>&nbsp;text<br>goes on here for some while, long enough.</p><p>Hm.
<div class="ad-box">Buy</div><ul><li>one<li>two</ul><form>Name <input></form><p>1 &lt; 2 < 3</p>%s
<section class="comments"><p>I liked it very much, it was great fun to read it all the way down.</p></section>
<aside><p>More to read in the sidebar of this page, and more and more.</p></aside><footer>&copy; Site</footer></body></html>"""
TEXT = "Big & small\nFirst bold text goes on here for some while, long enough.\nHm.\none\ntwo\n1 < 2 < 3"


@pytest.mark.parametrize("a,z", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=body>", "</div>"), ("", "")])
def test_html_template(a, z):
    assert html.extract(PAGE % (a, z)) == TEXT


def test_html_without_article():
    page = ("<body><div>Site name</div><div class=c><h1>Title</h1><div><p>%s</p><div class=ad>x</div><p>Short.</p></div></div>"
            "<div>All rights reserved</div></body>")
    assert html.extract(page % ("word " * 30)) == "Title\n" + ("word " * 30).strip() + "\nShort."


def test_html_window_sums_decide_over_tags():
    w, teaser = "word " * 30, "<article><h3>More</h3><p>A teaser that is longer than sixty characters, as teasers often are.</p></article>"
    body, text = f"<h1>Title</h1><p>{w}</p><p>Short.</p><p>{w}</p>", f"Title\n{w.strip()}\nShort.\n{w.strip()}"
    assert html.extract(f"<body><div class=c>{body}</div>{teaser}</body>") == text
    assert html.extract(f"<body>{2 * teaser}<div class=c>{body}</div>{2 * teaser}</body>") == text
    assert html.extract(f"<body><main><div>{body}</div><div>{2 * teaser}</div></main></body>") == text
    assert html.extract(f"<body><article>{body}</article><div>{teaser}</div><div>{w}</div></body>") == text


# the names of the finding, and wrappers whose whole class is a name
@pytest.mark.parametrize("name", ["content has-sidebar", "layout-with-sidebar", "no-comments", "post-share-enabled", "menu-open",
                                  "search-results", "social", "widget page"])
def test_html_names_do_not_drop_the_body(name):
    w = "word " * 70
    inner, text = f"<h1>Title</h1><p>{w}</p><div class='ad-box'>Buy this now</div><p>End.</p>", f"Title\n{w.strip()}\nEnd."
    for tag, attr in (("div", "class"), ("section", "id")):
        for a, z in (("<article>", "</article>"), ("", "")):
            assert html.extract(f"<body><div>Site</div><{tag} {attr}='{name}'>{a}{inner}{z}</{tag}></body>") == text
    for other in ("comments", "sidebar-box", "ad top", "site-nav"):
        assert html.extract(f"<body><div class=c>{inner}</div><div class='{other}'><p>{w[:200]}</p></div></body>") == text


def test_html_odd_input(spark):
    odd = [None, "", "plain text only", "<p>unclosed <b>bold", "<div><p>a</p", "<script>x", "<!-- never ended", "&amp;&#65;&bogus;",
           "<article></article>", "<p>" * 3000 + "deep", "<div>" * 3000 + "deep" + "</div>" * 3000]
    docs = spark.createDataFrame([(i, None, x) for i, x in enumerate(odd)] + [(0, "u", None)], "page_id bigint, url string, html string")
    got = {(r.page_id, r.url): r for r in html.extract_pages(docs).collect()}
    assert got[(0, None)].text == "" and got[(2, None)].text == "plain text only" and got[(3, None)].text == "unclosed bold"
    assert got[(7, None)].text == "&A&bogus;" and got[(9, None)].text == got[(10, None)].text == "deep"
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_html_line_blocks():
    assert html.block_sums([1, 0, 2, 0, 0, 5], 3) == [3, 2, 2, 5, 5, 5]
    assert html.stretches([0, 0, 0, 50, 40, 0, 3, 0, 0, 0, 0, 9], 60, 3) == [(1, 7)]


def test_decontamination_brute_force(spark):
    docs = spark.createDataFrame([(1, "A b c d e f g h i j k l"), (2, "x y"), (3, None), (4, ""), (5, "zz, QQ! zz qq"), (None, "zz qq zz"),
                                  (7, "a b c d e f g h i b c d e f g h i j k l m")], "doc_id bigint, text string") \
        .withColumn("T", F.lit(0)).withColumn("_bench_items", F.lit(0))
    bench = spark.createDataFrame([(10, "b c d e f g h i j k l"), (9, "ZZ qq"), (8, None), (7, ""), (None, "x y")], "item_id bigint, text string")
    for block in (200_000, 3):
        m, c = decontam.mark(docs, bench, max_windows=block)
        got = {r.doc_id: (r[c["n_words"]], r[c["spans"]], r[c["items"]], r[c["hit"]]) for r in m.collect()}
        assert got[1] == (12, [1, 12], ["10"], True) and got[2] == (2, [0, 2], [], True)
        assert got[3] == got[4] == (0, [], [], False)
        assert got[5] == (4, [0, 4], ["9"], True) and got[None] == (3, [0, 2], ["9"], True)
        assert got[7] == (21, [9, 20], ["10"], True)
    r = {x.doc_id: x for x in decontam.report(docs, bench).collect()}
    assert r[7].n_hit == 11 and r[7].items_sha256 == decontam.digest_of([10]) and not r[3].contaminated
    assert decontam.report(empty(spark), bench).count() == 0
    assert not any(x.contaminated for x in decontam.report(docs, bench.limit(0)).collect())


def test_decontamination_of_a_hot_window(spark):
    """800 items share their first window, and all their windows share a shingle: work does not grow with their number."""
    import time

    shared = "the very same ten words stand in all these items"
    items = [(i, f"{shared} x{i} the very same y{i} z{i} a b c d") for i in range(800)]
    docs = [(1, " ".join([shared] * 500)), (2, f"{shared} x5 the very same y5"), (3, "the very same " * 1500), (4, None)]
    win = decontam.Windows([(str(i), t) for i, t in items], 10, 3)
    win.order_by_rarity({})
    data, off = __import__("tabtext.llm.common", fromlist=["x"]).text_buffers(__import__("pyarrow").array([t for _, t in docs]))
    began = time.time()
    n_words, hits, found = decontam._scan(win, data, off)
    assert time.time() - began < 3
    assert n_words.tolist() == [5000, 15, 4500, 0] and found[0] == set(range(800)) == found[1] and found[2:] == [None, None]
    assert len(hits[0]) == 500 and sorted(hits[1]) == [(k, k + 10) for k in range(6)]
