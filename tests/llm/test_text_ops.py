"""op1, op2, op3, op4, op9 on small tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import fingerprints as FP
from tessera.llm import langid, licenses, pieces, toxicity
from tessera.llm.queries import tokenizer_file

DOC = "doc_id long, text string, lang string, id string, score string, row int"


def docs(spark, rows):
    """Rows of (doc_id, text[, lang]) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "x", "y", 1) for r in rows], DOC)


def key(rows):
    return sorted(rows, key=repr)


# ---------------------------------------------------------------- op1
def test_licenses_exact_near_partial_and_edge_cases(spark):
    mit = licenses.NOTICES[4].text
    words = mit.split()
    near = " ".join(w if i != 20 else "XXXX" for i, w in enumerate(words))
    half = " ".join(words[:len(words) // 2])
    filler = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, f"{filler} {mit} {filler}"), (2, near), (3, half), (4, None), (5, ""), (6, "released UNDER the MIT license!"),
            (6, "released UNDER the MIT license!"), (7, "MIT"), (None, "Licensed under CC BY-NC 4.0.")]
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    assert got == {(1, "MIT-text"), (2, "MIT-text"), (6, "MIT"), (None, "CC-BY-NC-4.0")}
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


def test_license_containment_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        t = rng.choice(licenses.NOTICES)
        words = [w if rng.random() > 0.03 else "changed" for w in t.text.split()]
        rows.append((i, " ".join([f"a{rng.randint(0, 50)}" for _ in range(rng.randint(0, 40))] + words)))

    def shingles(text):
        import re
        w = [x for x in re.sub(r"[^\w]+|_", " ", text.lower()).split(" ") if x]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = {}
    for i, text in rows:
        for t in licenses.NOTICES:
            s = shingles(t.text)
            if len(s & shingles(text)) >= 0.8 * len(s):
                want[(i, t.name)] = len(s & shingles(text)) / len(s)
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    assert got == pytest.approx(want) and len(want) > 20


def test_windows_are_hashed_only_of_texts_with_a_shingle_of_a_template(spark, monkeypatch):
    hashed = []
    real = licenses._with_permutations
    monkeypatch.setattr(licenses, "_with_permutations", lambda df, bands: hashed.append(df) or real(df, bands))
    filler = " ".join(f"w{i}" for i in range(300))
    rows = [(1, filler), (2, f"{filler} {licenses.NOTICES[0].text}"), (3, f"to deal in the software {filler}"), (4, None), (5, ""),
            (6, "released under the mit"), (2, f"{filler} {licenses.NOTICES[0].text}")]
    got = licenses.scan_licenses(docs(spark, rows)).collect()
    assert [(r.doc_id, r.license) for r in got] == [(2, "MIT")]
    assert key(r.id for r in hashed[-1].select("id").collect()) == [2, 3]


def test_bands_keep_their_promise():
    assert 1 - (1 - licenses.ALIKE) ** licenses.bands_for() >= licenses.COLLISION


# ---------------------------------------------------------------- op2
WORDS = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["straße", "grüße", "über", "möwe"], "cc": ["niño", "señor", "mañana", "año"]}


def language_rows(n=60):
    rng = random.Random(1)
    return [(i, " ".join(rng.choices(WORDS[lang], k=12)), lang) for i, lang in ((i, rng.choice(list(WORDS))) for i in range(n))]


def test_language_id_predicts_and_handles_edges(spark):
    model = langid.fit_language_filter(docs(spark, [*language_rows(), (900, None, "aa"), (901, "x", None)]))
    assert sorted(model.languages) == ["aa", "bb", "cc"]
    rows = [(1, "dolor lorem"), (2, "Möwe GRÜSSE über"), (3, None), (4, ""), (5, "123 !!"), (6, "señor " * 300_000), (6, "señor"), (None, "ipsum")]
    got = {(r.doc_id, r.lang_pred) for r in langid.identify_language(docs(spark, rows), model, ["doc_id"]).collect()}
    assert got == {(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (6, "cc"), (None, "aa")}
    out = langid.identify_language(docs(spark, rows), model, ["doc_id", "score", "id"])
    assert out.columns == ["doc_id", "score", "id", "lang_pred", "score", "n_grams"] and out.count() == len(rows)
    assert langid.identify_language(docs(spark, []), model, ["doc_id"]).count() == 0


def test_no_labelled_rows_gives_und(spark):
    model = langid.fit_language_filter(docs(spark, []))
    assert [r.lang_pred for r in langid.identify_language(docs(spark, [(1, "abc")]), model, ["doc_id"]).collect()] == ["und"]


def test_long_texts_are_cut_at_spaces_without_changing_counts(monkeypatch):
    model = langid.LanguageFilter.build([("aa", langid.grams(["lorem ipsum"])[0]), ("bb", langid.grams(["über möwe"])[0])])
    text = ["lorem über ipsum möwe " * 50, "", "lorem"]
    whole = model.predict(text)
    monkeypatch.setattr(langid, "SLICE", 40)
    cut = model.predict(text)
    assert whole[0] == cut[0] and (whole[1] == cut[1]).all() and (whole[2] == cut[2]).all()


def test_bloom_filter_has_no_false_negative():
    g = langid.grams(["the quick brown fox"])[0]
    f = langid.LanguageFilter.build([("x", g), ("y", g[:5])])
    assert (f.masks(g) & 1 == 1).all() and (f.masks(g[:5]) & 2 == 2).all()


# ---------------------------------------------------------------- op3
def brute_next(rows, terms=2):
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for i, (d, t) in enumerate(order):
        after, h = order[(i + 1) % len(order)][1], len(t) // 2
        yield d, t, after, t[:len(t) - h] + after[:h]


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_edited_texts_and_exact_equalities(spark, buckets):
    rng = random.Random(2)
    rows = [(i * 7, " ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(3, "same text here"), (4, "same text here"), (5, None), (6, ""), (4, "zweite Zeile über é 漢字"), (4, "same text here")]
    got = FP.edited_fingerprints(docs(spark, rows), buckets=buckets).collect()
    want = sorted((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, _, e in brute_next(rows))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    text = {(d, len(t), hashlib.sha256(e.encode()).hexdigest()): t for d, t, _, e in brute_next(rows)}
    by_text = {}
    for r in got:
        by_text.setdefault(text[(r.doc_id, r.n_chars, r.edited_sha256)], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_one_empty_and_null_id_tables(spark):
    assert FP.edited_fingerprints(docs(spark, [])).count() == 0
    (r,) = FP.edited_fingerprints(docs(spark, [(9, "a b c d")])).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b a b"[:7]).hexdigest()
    assert FP.edited_fingerprints(docs(spark, [(None, "a"), (None, "b")])).count() == 2


def test_collision_rate_is_generalised_jaccard(spark):
    a = " ".join(["x y"] * 3 + [f"p{i} q{i}" for i in range(60)])
    b = " ".join(["x y"] * 6 + [f"p{i} q{i}" for i in range(20, 80)])
    df = spark.createDataFrame([(1, a, b)], "k int, a string, b string")
    (r,) = FP.fingerprints(df, ["k"], {"a": "fa", "b": "fb"}, samples=400, words=1).collect()
    from collections import Counter
    u, v = Counter(a.split()), Counter(b.split())
    want = sum((u & v).values()) / sum((u | v).values())
    assert abs(np.mean([x == y for x, y in zip(r.fa, r.fb, strict=True)]) - want) < 0.08


def test_fingerprints_need_one_shuffle_and_no_python(spark):
    plan = FP.edited_fingerprints(docs(spark, [(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- op4
ODD = ["a▁b", "  two  spaces ", "漢字 emoji 😀 x", "▁▁▁", "\n\n a", "x\x00y\x01", "", " ", "a", "\t", "<s> </s> <0x41>", "é " * 5000]


def test_pieces_equal_the_library_and_round_trip(spark):
    from sentencepiece import SentencePieceProcessor
    path = tokenizer_file("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (50, None), (None, "null id")]
    got = pieces.encode_pieces(docs(spark, rows), path, decoded=True).collect()
    assert key((r.doc_id, list(r.ids), r.decoded) for r in got) == key((d, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for d, t in rows)
    for r in got:
        raw = (dict(rows)[r.doc_id] or "").encode()
        assert b"".join(raw[a:z] for a, z in zip(r.begins, r.ends, strict=True)) == raw  # the spans tile the text
    back = pieces.decode_pieces(pieces.encode_pieces(docs(spark, rows), path, spans=False), path).collect()
    assert key((r.doc_id, r.text) for r in back) == key((r.doc_id, r.decoded) for r in got)
    assert pieces.encode_pieces(docs(spark, []), path).count() == 0


def char_map(rules: dict[bytes, bytes]) -> bytes:
    """A compiled map with the given rules: a double array built by first fit, and the replacements."""
    strings, where = b"", {}
    for k, v in rules.items():
        where[k] = len(strings)
        strings += v + b"\0"
    units, used, bases = {0: 0}, {0}, set()

    def place(node, prefix):
        heads = sorted({k[len(prefix)] for k in rules if k.startswith(prefix) and len(k) > len(prefix)})
        labels = ([None] if prefix in rules else []) + heads
        base = next(b for b in range(1, 1 << 16) if b not in bases and all((b ^ (x or 0)) not in used for x in labels))
        bases.add(base)
        used.update(base ^ (x or 0) for x in labels)
        units[node] = units.get(node, 0) | ((node ^ base) << 10) | ((1 << 8) if prefix in rules else 0)
        if prefix in rules:
            units[base] = 0x80000000 | where[prefix]
        for x in heads:
            units[base ^ x] = x
            place(base ^ x, prefix + bytes([x]))

    place(0, b"")
    array = np.zeros(max(units) + 256, dtype="<u4")
    for i, u in units.items():
        array[i] = u
    return len(array.tobytes()).to_bytes(4, "little") + array.tobytes() + strings


def test_longest_prefix_normalisation_records_its_source():
    rules = {"ﬁ".encode(): b"fi", "Ａ".encode(): b"A", b"ab": b"X", b"abc": b"YY", b"\t": b" "}
    n = pieces.Normalizer(char_map(rules), dummy_prefix=True, trim=False)
    text = "zabcd ab\tﬁＡ".encode()
    norm, src = n.normalize(text)
    assert norm.decode() == "▁zYYd▁X▁fiA"
    assert src[3:].tolist() == [0, 1, 1, 4, *[5] * 3, 6, *[8] * 3, 9, 9, 12, 15]
    trimmed, where = pieces.Normalizer(b"", dummy_prefix=True, trim=True).normalize(b"  a  b ")
    assert trimmed.decode() == "▁a▁b" and where[-1] == 6


def test_spans_of_a_marked_text_follow_the_alignment():
    c = pieces.PieceCodec(tokenizer_file("piece_bpe_32k.model"))
    batch = pa.array(["a▁b  c"])
    ids, ends, width = c.encode(batch)
    begin, end = c.spans(batch, ids, ends, width)
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == c.encode_one("a▁b  c")[1]


def test_alignment_of_a_batch_is_that_of_each_text():
    c = pieces.PieceCodec(tokenizer_file("piece_bpe_32k.model"))
    batch = pa.array(["cut off", *ODD, None, "▁ ▁x "])[1:]
    norm, stops, src, sizes = c.normalizer.normalize_plain(batch.fill_null(""))
    ids, ends, width = c.encode(batch)
    begin, end = c.spans(batch, ids, ends, width)
    for i, t in enumerate(batch.to_pylist()):
        a, z = [0, *stops][i], stops[i]
        alone, where = c.normalizer.normalize((t or "").encode())
        assert (norm[a:z].tobytes(), [*src[a:z], sizes[i]]) == (alone, where.tolist())
        a, z = [0, *ends][i], ends[i]
        assert list(zip(begin[a:z].tolist(), end[a:z].tolist(), strict=True)) == c.encode_one(t or "")[1]


def test_op4_returns_a_digest_of_the_spans(spark, tmp_path):
    import hashlib
    from tessera.llm.queries import queries
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    c = pieces.PieceCodec(tokenizer_file("piece_bpe_32k.model"))
    want = {}
    for d, t in rows:
        begin, end = ([str(s[k]) for s in c.encode_one(t or "")[1]] for k in (0, 1))
        want[d] = hashlib.sha256(f"{','.join(begin)};{','.join(end)}".encode()).hexdigest()
    got = queries()["op4_sentencepiece"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.spans_sha256 for r in got} == want and len(got) == len(rows)


# ---------------------------------------------------------------- op9
def test_nnpu_learns_from_positives_and_unlabelled():
    rng = random.Random(3)
    clean = [sorted(rng.sample(range(5, 40), 4)) for _ in range(900)]
    toxic = [sorted({rng.randint(0, 4), *rng.sample(range(5, 40), 3)}) for _ in range(300)]
    w, b = toxicity.nnpu_fit(toxic[:150], clean + toxic[150:250], 40, 0.1)
    model = toxicity.ToxicityModel([str(i) for i in range(40)], w, b)
    assert (model.score(toxic[250:]) > 0.5).mean() > 0.9 and (model.score(clean) < 0.3).mean() > 0.95


def test_toxicity_end_to_end_and_edges(spark):
    rng = random.Random(4)
    good, bad = [f"word{i}" for i in range(40)], ["vile", "nasty", "awful"]
    rows = [(i, " ".join(rng.choices(good, k=15) + (rng.choices(bad, k=2) if i % 8 == 0 else []))) for i in range(400)]
    d = docs(spark, rows)
    model = toxicity.fit_toxicity(d, d.filter(F.col("doc_id") % 8 == 0).select("doc_id"), 0.125)
    test = [(1, "word1 VILE, word2"), (2, "word3 word4"), (3, None), (4, ""), (5, "word1 " * 20_000 + "nasty"), (None, "awful"), (2, "word3 word4")]
    got = toxicity.score_toxicity(docs(spark, test), model, ["doc_id"]).collect()
    assert {(r.doc_id, r.predicted) for r in got} == {(1, 1), (2, 0), (3, 0), (4, 0), (5, 1), (None, 1)} and len(got) == 7
    empty = toxicity.fit_toxicity(docs(spark, []), d.limit(0).select("doc_id"), 0.1)
    assert [r.predicted for r in toxicity.score_toxicity(docs(spark, test[:1]), empty, ["doc_id"]).collect()] == [0]
    assert toxicity.score_toxicity(docs(spark, []), model, ["doc_id"]).count() == 0


def test_toxicity_on_small_label_tables_leaves_clean_texts_alone(spark):
    for n in (5, 50, 500):
        rng = random.Random(n)
        rows = []
        for i in range(n):
            w = [f"word{rng.randint(0, 60)}" for _ in range(rng.randint(5, 40))]
            toxic = rng.random() < 0.1
            rows.append((i, " ".join(w + ["vilest", "slurxyz"] * 2 if toxic else w), int(toxic)))
        table = docs(spark, [(d, t) for d, t, _ in rows] + [(10 ** 6, None), (10 ** 6 + 1, "")])
        labels = spark.createDataFrame([(d,) for d, _, y in rows if y], "doc_id long")
        prior = min(0.5, max(0.001, sum(y for *_, y in rows) / n))
        model = toxicity.fit_toxicity(table, labels, prior)
        got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score_toxicity(table, model, ["doc_id"]).collect()}
        assert got[10 ** 6][0] <= prior + 1e-9 and got[10 ** 6 + 1] == got[10 ** 6]
        clean = [got[d][1] for d, _, y in rows if not y]
        assert sum(clean) <= len(clean) * 0.2


def test_toxicity_gradient_step_lowers_the_risk():
    """The fit against the risk worked out text by text."""
    rng = random.Random(2)
    pos = [sorted({0, rng.randint(2, 5)}) for _ in range(30)]
    unl = [sorted({rng.choice([0, 1, 1, 1]), rng.randint(2, 5)}) for _ in range(80)]

    def risk(w, b, prior):
        def mean(rows, sign):
            return sum(np.logaddexp(0, -sign * (b + sum(w[i] for i in r))) for r in rows) / len(rows)
        return prior * mean(pos, 1) + max(0.0, mean(unl, -1) - prior * mean(pos, -1))

    w, b = toxicity.nnpu_fit(pos, unl, 6, 0.25, epochs=300)
    start = risk(np.zeros(6), np.log(0.25 / 0.75), 0.25)
    best = risk(w, b, 0.25)
    assert best < 0.6 * start and w[0] > 0 > w[1]
