"""op5, op6, op7, op8, op10 and the pipeline on small tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import html_text, ngram_join, packing, topk
from tessera.llm.queries import URL_RULES, tokenizer_file
from tessera.llm.urls import UrlRule, filter_urls
from tests.llm import brute

DOC = "doc_id long, text string, lang string, source string, n_chars long, comp string, node long, key long"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "c", 1, 2) for d, t in rows], DOC)


# ---------------------------------------------------------------- op5
@pytest.mark.parametrize("lists,block", [(1, 4096), (2, 7), (3, 16)])
def test_top_k_equals_brute_force(spark, monkeypatch, lists, block):
    monkeypatch.setattr(topk, "SLICE", 3)
    rng = random.Random(7)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(70)]
    vectors += [(100 + i, vectors[10][1]) for i in range(30)]  # one common vector: ties by id
    vectors += [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6),
                (20, vectors[20][1]), (None, vectors[3][1]), (340, []), (350, [0.5])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns({"query": F.lit(1), "score": F.lit(2)})
    rows = df.select("vec_id", topk.scaled("embedding").alias("v"))
    got = topk.top_k(rows, F.col("vec_id") % 10 == 0, lists=lists, block=block).collect()
    clean = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean[i] = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
    want = set()
    for q in (i for i in clean if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(clean[q], clean[c], strict=False)), c) for c in clean if c != q)
        want |= {(q, r, c, -s) for r, (s, c) in enumerate(scores[:10], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)


def test_top_k_of_few_and_none(spark):
    two = spark.createDataFrame([(0, [1]), (1, [2])], "vec_id long, v array<long>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2)]
    assert topk.top_k(two.limit(0), F.lit(True)).count() == 0


def test_top_k_counts_repeated_rows_of_a_class_once(spark):
    rows = [(i, [3, 1]) for i in range(1, 21) for _ in range(2)] + [(30, [2, 9])] * 15 + [(31, [2, 9]), (32, [2, 9])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id").isin(1, 30)).collect()}
    want = {(1, r, i, s) for r, (i, s) in enumerate([(30, 15), (31, 15), (32, 15), *((i, 10) for i in range(2, 9))], 1)}
    want |= {(30, r, i, s) for r, (i, s) in enumerate([(31, 85), (32, 85), *((i, 15) for i in range(1, 9))], 1)}
    assert got == want


# ---------------------------------------------------------------- op6
def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, ch in enumerate(rest) if ch in "/?#"), len(rest))
    host = rest[:cut].translate({i: i + 32 for i in range(65, 91)})
    path = rest[cut:]
    path = path[:next((i for i, ch in enumerate(path) if ch in "?#"), len(path))]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


URLS = ["http://a.net/fr/x?y#z", "https://WWW.Example.COM/en/1", "http://example.com/en/", "http://example.com/en", "http://com/", "x.com/",
        None, "", "http://", "ftp://a.b.com?/x", "http://a.example.com//en/", "http://é.net/es/ü", "http://notexample.com/en/", "a://b://c.net/fr/",
        "http://net/es/", "http://x\ny.com/a", "http://" + "a." * 400 + "net/fr/" + "p/" * 2000]


def test_urls_equal_plain_rules(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS)] + [(3, URLS[3], "h", 1), (None, URLS[0], "h", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, prefix int")
    rules = [*URL_RULES, UrlRule("block", "example.com", "/en/"), UrlRule("allow", "b.com", "")]
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(df, rules).collect()]
    want = [(i, *plain_verdict(u, rules)) for i, u, _, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert filter_urls(df.limit(0), rules).count() == 0 and filter_urls(df, []).filter("verdict = 'allow'").count() == len(rows)
    plan = filter_urls(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# ---------------------------------------------------------------- op7
def near_copies(seed, n=140):
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 8, 30, 90, 500]))] for _ in range(12)]
    passage = [f"common{i}" for i in range(40)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
        if rng.random() < 0.4:
            w = w[:rng.randint(0, len(w))] + passage + [f"z{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 12))]
        rows.append((i * 3, " ".join(w)))
    return rows + [(1, None), (2, ""), (4, " \t"), (5, "One Two"), (7, "one\ttwo"), (8, "x"), (9, "x"), (3, rows[1][1]), (3, rows[1][1]),
                   (None, rows[2][1]), (10, "lone " * 30_000)]


@pytest.mark.parametrize("seed,small,frequent", [(1, 64, 0.002), (2, 2, 0.002), (3, 3, 0.2), (4, 64, 0.5)])
def test_components_equal_brute_force(spark, monkeypatch, seed, small, frequent):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = near_copies(seed)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(brute.jaccard_components(rows), key=repr)


def test_components_of_nothing(spark):
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0
    assert [(r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, [(7, None)])).collect()] == [(0, 7)]


def test_component_rounds_are_right_and_shuffle_three_times(spark, monkeypatch):
    plans, cut = [], ngram_join.cut

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(ngram_join, "cut", noted)
    chain = [(i, i + 1) for i in range(20, 60)] + [(30, 7), (100, 101), (102, 101), (101, 101), (5, 5)]
    found = ngram_join.connected(spark.createDataFrame(chain, "a long, b long"))
    want = {(i, 7) for i in [7, *range(20, 61)]} | {(i, 100) for i in (100, 101, 102)}
    assert {tuple(r) for r in found.collect()} | {(7, 7), (100, 100)} == want
    assert len(plans) > 2 and all(p.count("Exchange hashpartitioning") <= 3 for p in plans)
    plans.clear()
    more = ngram_join._merged(found, spark.createDataFrame([(102, 60), (200, 201)], "a long, b long"))
    assert {tuple(r) for r in more.collect()} | {(7, 7), (200, 200)} == {(n, 7) for n, _ in want} | {(200, 200), (201, 200)}
    plans.clear()
    assert ngram_join._merged(found, spark.createDataFrame([], "a long, b long")) is found and not plans


def test_prefix_keys_meet_for_every_linked_pair():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 1 << 62, 2000, dtype=np.uint64)
    frequent = ngram_join.FrequentTokens(tokens[:700], np.arange(700))
    for n in (6, 7, 20, 100, 339, 341, 400, 469, 472, 900):
        for _ in range(12):
            x = rng.choice(tokens, n, replace=False)
            y = np.concatenate([x[:n - n // 20], rng.choice(tokens, n // 25, replace=False)])
            x, y = np.unique(x), np.unique(y)
            common = len(np.intersect1d(x, y))
            if 100 * common >= 85 * (len(x) + len(y) - common):
                a, b = (ngram_join.index_keys(s, frequent, 85)[0] for s in (x, y))
                assert len(np.intersect1d(a, b)) or np.array_equal(x, y), n


# ---------------------------------------------------------------- op8
def test_main_text_by_markup_and_by_host(spark):
    menu = "<nav>home about</nav><div>all rights are reserved by the owners of this site</div>"
    art = ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav>x<ul><li>y</li></ul></nav><!-- c --><div class='ad big'>buy</div>"
           "<article><h1>A &amp; b</h1><p>one\n  two<p>three<br>four <b>bold</b>&copy;<script>var t='</p>';</script></p><aside>no</aside>"
           "<div id=comments>c</div><form>f</form></article><footer>z</footer></body>")
    rows = [(1, "http://h.com/1", f"{menu}<div>first page text</div>"), (2, "http://h.com/2", f"{menu}<div>second page words</div>"),
            (2, "http://h.com/2", f"{menu}<div>second page words</div>"), (3, None, None), (4, "http://x.y/", ""), (None, "u://q/", art),
            (5, "http://one.com/", "<p>all alone</p>"), (6, "u", "<main>cut off &am"), (7, "v", "no markup &lt;b&gt;"), (8, "w", "<article></article><p>out</p>")]
    df = spark.createDataFrame([(*r, "t", True) for r in rows], "page_id long, url string, html string, text string, has_main boolean")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract_main_text(df).collect()), key=repr)
    text = {1: "first page text", 2: "second page words", 3: "", 4: "", None: "A & b\none two\nthree four bold©", 5: "all alone",
            6: "cut off &am", 7: "no markup <b>", 8: ""}
    assert got == sorted(((i, u, text[i], len(text[i])) for i, u, _ in rows), key=repr)
    assert html_text.extract_main_text(df.limit(0)).count() == 0


def test_repeated_substrings_equal_brute_force():
    rng = random.Random(9)
    pages = [[rng.choice("abc") for _ in range(rng.randint(0, 60))] for _ in range(7)]
    cover = html_text.repeated(pages, 5)
    for i, p in enumerate(pages):
        want = [False] * len(p)
        for a in range(len(p) - 4):
            if any(p[a:a + 5] == q[b:b + 5] for j, q in enumerate(pages) if j != i for b in range(len(q) - 4)):
                want[a:a + 5] = [True] * 5
        assert cover[i].tolist() == want


def test_every_stream_goes_through_the_suffix_array(monkeypatch):
    seen, repeated = [], html_text.repeated

    def noted(streams, *more):
        seen.append((streams, cover := repeated(streams, *more)))
        return cover

    monkeypatch.setattr(html_text, "repeated", noted)
    article = [" ".join(f"a{i}" for i in range(12)), "the end"]
    passage, legal = " ".join(f"p{i}" for i in range(9)), " ".join(f"l{i}" for i in range(10))
    rest = [[legal], [legal, "seen once"], [], [legal, passage, "own words"], [passage]]
    main = [article, article, ["new", passage], None, None]
    text = html_text.main_texts(rest, main)
    assert text == ["\n".join(article)] * 2 + [f"new\n{passage}", "own words", ""]
    (streams, cover), = seen
    assert streams == [" ".join(bs or ()).split() for bs in (*rest, *main)]
    # copies and passages inside are marked, given back; outside only what another page shows outside counts
    assert [int(c.sum()) for c in cover] == [10, 10, 0, 19, 9, 14, 14, 9, 0, 0]
    assert html_text.main_texts(rest[2:4], main[2:4]) == [f"new\n{passage}", f"{legal}\n{passage}\nown words"]


def test_repeated_inside_and_outside_equals_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        n, least = rng.randint(1, 8), rng.choice([1, 2, 3, 5])
        streams = [[f"w{rng.randint(0, 3)}" for _ in range(rng.randint(0, 14))] for _ in range(n)]
        page, inside = np.array([rng.randint(0, 4) for _ in range(n)]), np.array([rng.random() < 0.5 for _ in range(n)])
        runs = [{tuple(s[i:i + least]) for i in range(len(s) - least + 1)} for s in streams]
        for k, got in enumerate(html_text.repeated(streams, least, page, inside)):
            others = set().union(*[runs[j] for j in range(n) if page[j] != page[k] and (inside[k] or not inside[j])])
            want = [False] * len(streams[k])
            for i in range(len(want) - least + 1):
                if tuple(streams[k][i:i + least]) in others:
                    want[i:i + least] = [True] * least
            assert got.tolist() == want


def test_main_text_does_not_depend_on_shares(spark, monkeypatch):
    rng = random.Random(12)
    notices = [" ".join(f"n{k}x{i}" for i in range(rng.choice([7, 8, 9, 20]))) for k in range(12)]
    rows = []
    for i in range(40):  # each notice on a few of the pages, in the middle of a block or over two
        own = [f"p{i}w{j}" for j in range(rng.randint(0, 25))]
        cut = rng.randint(0, len(own))
        some = " ".join(rng.sample(notices, 2) if i % 5 else [])
        host = "big.com" if i < 34 else "small.com"
        rows.append((i, f"http://{host}/{i}", f"<div>{' '.join(own[:cut])} {some}</div><p>{' '.join(own[cut:])}</p>"
                     + ("<article>kept</article>" if i % 7 == 0 else "")))
    rows += [(3, *rows[3][1:]), (None, "http://big.com/3", rows[4][2]), (50, "http://big.com/50", None), (51, None, notices[0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")

    def texts_of(pages_in_a_share):
        monkeypatch.setattr(html_text, "HOST_PAGES", pages_in_a_share)
        return sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract_main_text(df).collect()), key=repr)

    whole = texts_of(512)
    assert len(whole) == len(rows) and texts_of(2) == whole and texts_of(1) == whole


# ---------------------------------------------------------------- op10
def test_packing_places_every_token_once(spark):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["Thand", "für,", "x1", "don't", "ÉA", "<|endoftext|>"]) for _ in range(rng.choice([0, 1, 30, 400, 3000]))))
            for i in range(50)] + [(90, None), (91, ""), (92, " \n "), (3, "again"), (3, "again"), (None, "null id")]
    out = packing.pack_pieces(packing.tokenize_pieces(docs(spark, rows), path), shard_rows=25).toPandas()
    want = []
    for d, t in rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want.append((d, k, a, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    got = [(None if d != d else int(d), *r) for d, *r in out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        ends = s["offset"] + s["length"]
        assert s["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 2048
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 2048) + 6
    assert packing.pack_pieces(packing.tokenize_pieces(docs(spark, []), path)).count() == 0


def test_sum_of_squares_follows_its_rule():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 21, 200)
    bins, offsets, made = packing.sum_of_squares(lengths, 20)
    gaps: dict[int, int] = {}
    for s, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        def after(g, s=s):
            n = np.bincount([x for x in gaps.values()] or [0], minlength=21).astype(int)
            n[0] = 0
            n[g] -= g < 20 or 0
            n[g - s] += 1
            n[0] = 0
            return int((n[:20] ** 2).sum())
        options = {g: after(g) for g in {*gaps.values(), 20} if g >= s}
        gap = gaps.get(b, 20)
        assert o == 20 - gap and options[gap] == min(options.values())
        gaps[b] = gap - s
        if not gaps[b]:
            gaps[b] = 0
    assert made == len(set(bins.tolist()))


# ---------------------------------------------------------------- pipeline
def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark):
    import corpus_pipeline
    rng = random.Random(3)
    word = [f"w{i}" for i in range(100)]
    near, far = list(word), list(word)
    for i in (30, 60):  # 86 of 106 shingles of five words, 89 of 105 of four
        near[i] = f"x{i}"
    for i in (20, 50, 80):  # 81 of 111
        far[i] = f"y{i}"
    rows = [(1, " ".join(word)), (2, " ".join(near)), (3, " ".join(far)), (4, None)]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs(spark, rows), "").collect()) == [1, 3, 4]
    many = near_copies(rng.randint(5, 9))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, many), size=5, percent=80).collect()]
    assert sorted(got, key=repr) == sorted(brute.jaccard_components(many, 5, 80), key=repr)


def test_near_duplicate_stage_keeps_one_row_a_group(spark):
    import corpus_pipeline
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(None, a), (None, b), (1, b), (2, c), (3, b), (3, c + " end"), (None, a + " end"), (4, "d d"), (4, "d  d"), (None, None), (None, ""), (5, None), (5, None)]
    out = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_stage(spark, docs(spark, rows), "").collect()]
    group = sorted("end" if t == a + " end" else "a" if t == a else "d" if t and t[0] == "d" else repr((d, t)) for d, t in out)
    assert len(out) == 7 and (1, b) in out and (2, c) in out and sorted(out.count(x) for x in [(None, None), (None, ""), (5, None)]) == [1, 1, 1]
    assert group.count("d") == 1 and group.count("a") + group.count("end") == 1


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(8)
    good = [f"lorem{i} ipsum" for i in range(60)]
    rows = [(i, " ".join(rng.choices(good, k=30)) + (" vile nasty" if i % 9 == 0 else "")) for i in range(300)]
    rows += [(900, rows[1][1]), (901, rows[1][1] + " more"), (902, None), (903, "12 34"), (1, rows[1][1])]
    df = spark.createDataFrame([(d, t, "la", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(d, 1, int("vile" in t)) for d, t in rows[:300]], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(out["doc_id"]) == {d for d, t in rows[:300] if "vile" not in t}
    assert len(out) == out["doc_id"].nunique() and [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_join", "packing"]


# ---------------------------------------------------------------- ids, copies and columns that clash
BIG = [(1 << 60) + 1, None, (1 << 60) + 3, (1 << 60) + 2]


def test_packing_keeps_large_and_null_ids_and_splits_copies(spark):
    rows = [(d, f"some words of {i}") for i, d in enumerate(BIG)] + [(7, "a copy")] * 40
    pieces = packing.tokenize_pieces(docs(spark, rows), tokenizer_file("word_bpe_49k.json"), size=16)
    got = packing.pack_pieces(pieces, size=16, shard_rows=9).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((d for d, _ in rows), key=repr)
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    copies = {r.sequence_id >> 32 for r in got if r.doc_id == 7}
    assert len(copies) > 1  # the copies lie in several shards


def test_pages_with_large_ids_and_equal_ids_but_other_html(spark):
    def page(words):
        return f"<html><body><p>{words}</p></body></html>"
    rows = [(d, "http://h.example/a", page(f"this page alone says number {i} and nothing else")) for i, d in enumerate(BIG)]
    rows += [(5, "http://h.example/b", page("one version of the page")), (5, "http://h.example/b", page("another version of the page"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.text) for r in html_text.extract_main_text(df).collect()), key=repr)
    assert got == sorted(((d, h[15:-18]) for d, _, h in rows), key=repr)


def test_pipeline_stages_with_columns_named_like_their_own(spark, tmp_path):
    import corpus_pipeline as P
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + rng.choice("abc") for _ in range(30)) for _ in range(12)]
    rows = [(i, t, "en", "lp", 0.5, 1, 9, "d") for i, t in enumerate(texts)] + [(None, None, None, "lp", 0.5, 1, 9, "d"), (50, "", "en", "lp", 0.5, 1, 9, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double, predicted int, n_grams int, _doc0 string")
    spark.createDataFrame([(i, 0) for i in range(12)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = P.language_stage(spark, df, str(tmp_path))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(12))
    assert {(r.lang_pred, r.score, r["_doc0"]) for r in kept.collect()} == {("lp", 0.5, "d")}
    clean = P.toxicity_stage(spark, df, str(tmp_path))
    assert clean.columns == df.columns and clean.count() == 14


def test_large_groups_of_texts_that_do_not_link(spark, monkeypatch):
    """Variants of one text, most pairs of which stay below the bound, in groups above SMALL."""
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(140)]
    rows = []
    for i in range(60):
        w = [x if rng.random() > 0.02 * (i % 4) else f"x{rng.randint(0, 999)}" for x in base]
        rows.append((i, " ".join(w)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, rows)).collect())
    assert got == sorted(brute.jaccard_components(rows))
    assert 1 < len({c for _, _, c in got}) < 60


def test_nodes_of_large_groups_meet_once_a_first_token(spark):
    """Pair keys with one first token are one group, unless their own groups hold fewer pairs."""
    near = [(100 * a + b, node, 40, i) for node in (1, 2, 3, 4) for i, a in enumerate((7, 8, 9)) for b in (7, 8, 9) if a < b]
    apart = [(51, node, 40, 2) for node in (11, 12, 13)] + [(52, node, 40, 2) for node in (14, 15, 16)]
    long = [(7, node, 900, 5) for node in (21, 22)]
    heads = {1: [7, 8, 9], 11: [0, 0, 5], 21: None}
    stored = spark.createDataFrame([(node, heads[max(h for h in heads if h <= node)], bytearray(1)) for _, node, _, _ in near + apart + long],
                                   "node long, heads array<long>, bits binary")
    large = spark.createDataFrame(near + apart + long, "key long, node long, n long, at long")
    comp = spark.createDataFrame([(1, 1), (2, 1)], "node long, comp long")
    got = sorted(tuple(r) for r in ngram_join._gathered(large, stored, comp).collect())
    assert got == sorted([(group, node, 40, at, 1 if node == 2 else node) for node in (1, 2, 3, 4) for group, at in ((7, 0), (8, 1))]
                         + [(7, node, 900, 5, node) for node in (21, 22)] + [(key, node, n, at, node) for key, node, n, at in apart])


def test_first_shared_token_is_the_first_of_a_shared_key():
    """Of linked sets, at the positions which that key has in both."""
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 1 << 62, 2000, dtype=np.uint64)
    frequent = ngram_join.FrequentTokens(tokens[:900], np.arange(900))
    seen = 0
    for n in (20, 100, 339, 341, 400, 469, 472, 900):
        for _ in range(12):
            x = rng.choice(tokens, n, replace=False)
            x, y = np.unique(x), np.unique(np.concatenate([x[:n - n // 20], rng.choice(tokens, n // 25, replace=False)]))
            common = len(np.intersect1d(x, y))
            if np.array_equal(x, y) or 100 * common < 85 * (len(x) + len(y) - common):
                continue
            keys = []
            for s in (x, y):
                k, at, heads = ngram_join.keys_and_heads(s, frequent, 85)
                keys.append({v: (p, v if heads is None else heads[p]) for v, p in zip(k.tolist(), at.tolist(), strict=True)})
            (i, t), (j, u) = min((keys[0][v], keys[1][v]) for v in keys[0].keys() & keys[1].keys())
            orders = [np.concatenate(frequent.split(s)) for s in (x, y)]
            first = next(v for v in orders[0] if v in orders[1])
            assert (t, u, orders[0][i], orders[1][j]) == (first,) * 4
            seen += 1
    assert seen > 30


def test_short_parities_never_rule_out_a_link():
    rng = np.random.default_rng(0)
    for n in (3, 40, 200, 300, 2000):
        s = rng.integers(0, 1 << 63, n).astype(np.uint64)
        t = np.concatenate([s[: n - n // 20], rng.integers(0, 1 << 63, n // 20).astype(np.uint64)])
        apart = len(np.setxor1d(s, t))
        x, y = (np.frombuffer(ngram_join.parity(np.unique(v)), dtype=np.uint8) for v in (s, t))
        for size in (32, 128):
            if len(x) >= size and len(y) >= size:
                assert int(np.bitwise_count(ngram_join.folded(x, size) ^ ngram_join.folded(y, size)).sum()) <= apart
