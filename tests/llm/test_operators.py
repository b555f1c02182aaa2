"""Each operator against a plain version, with nulls, empty and long texts, ties, repeats, empty tables, other columns."""

import base64
import hashlib
from collections import Counter
import math
import pickle
import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from daypanel.llm import (
    archives, decontamination, importance, language_id, mixing, packing, path_templates, repeats, rule_votes, set_join,
)

DOCS = "doc_id long, text string, kept string, source string"
RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def edited(text, every, seed):
    words = text.split(" ")
    for i in range(seed % every, len(words), every):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    base = prose(300, 1)
    texts = [base, base, edited(base, 90, 2), edited(base, 70, 3), edited(base, 20, 4), prose(200, 5), None, "", " \t\n ", "one", "One two", "one two"]
    texts += ["x" * 3000, "ab " * 1500, base + " " + prose(40, 6), prose(90, 7) + " " + base[:900], "Große Übung, ÉTÉ\n" * 40, prose(9000, 8), "\n".join(["a b c d e f"] * 3)]
    return [(i, t, "other", "s" if i % 3 else None) for i, t in enumerate(texts)] + [(5, texts[5], "other", "s")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_repeats(docs, rows, none):
    expected = sorted((r[0], *x) for r, x in zip(rows, brute.kept_bytes([r[1] for r in rows], 400)))
    found = repeats.without_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == expected
    assert all(sum(b - a for a, b in r.spans) == r.n_removed for r in found)
    assert repeats.without_repeats(none).count() == 0


def test_repeats_of_a_frequent_symbol(docs, rows, monkeypatch):
    """Routing by all symbols changes nothing."""
    monkeypatch.setattr(repeats, "HOT_ROWS", 1)
    expected = sorted((r[0], x[1]) for r, x in zip(rows, brute.kept_bytes([r[1] for r in rows], 400)))
    assert sorted((r.doc_id, r.n_removed) for r in repeats.without_repeats(docs).collect()) == expected


def test_repeats_of_a_frequent_edge(spark, docs, rows, monkeypatch):
    """Members of a frequent name are counted by key and not held in a task; bytes found are the same."""
    kept = repeats.materialised
    made = []
    monkeypatch.setattr(repeats, "materialised", lambda df, label: made.append((label, kept(df, label))) or made[-1][1])
    monkeypatch.setattr(repeats, "HOT_NAMES", 2)
    passage = prose(200, 51)[:390]
    around = lambda i: random.Random(i).choice("stu") * (i % 4 * 6)
    more = [(100 + i, prose(20, 600 + i) + around(i) + passage + around(i + 1) + prose(20, 700 + i), "o", "s") for i in range(24)]
    every = [*rows, *more, more[3]]
    expected = sorted((r[0], *x[1:]) for r, x in zip(every, brute.kept_bytes([r[1] for r in every], 400)))
    found = repeats.without_repeats(spark.createDataFrame(every, DOCS).repartition(3)).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == expected
    sizes = {label: frame.count() for label, frame in made if label.startswith("hot-")}
    assert sizes["hot-names"] > 0 and sizes["hot-matches"] > 0


def test_interleave_refinement():
    """Blocks of the merge are the groups of equal symbol strings."""
    rng = np.random.default_rng(1)
    symbols = [rng.integers(0, 3, 200).astype(np.uint64) for _ in range(4)]
    order, core, whole = repeats.merged(symbols, np.ones(200, int))
    names = list(zip(*(s.tolist() for s in symbols)))
    groups = {}
    for i, c in zip(order, core):
        groups.setdefault(c, set()).add(names[i][:2])
    assert all(len(g) == 1 for g in groups.values())
    assert [bool(w) for w in whole] == [names.count(names[i]) > 1 for i in order]


def test_archives(spark, tmp_path):
    pages = [(i, f"http://Host{i % 3}.example.org/a?{i % 4}", h, 1) for i, h in enumerate(["x", "x", None, "", "é\r\n\r\nWARC/1.1", "y" * 50000, "x"])]
    pages += [(6, "http://h", "x", 1), (None, None, "x", 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, record_type int")
    found = archives.archived(frame, str(tmp_path / "w"), archive_bytes=1000).collect()
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, _, h, _ in pages:
        if i is not None:
            first.setdefault(h or "", i)
    assert sorted((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in found if r.page_id is not None) == sorted(
        (False, i, len((h or "").encode()), digest(h), first[h or ""] if first[h or ""] != i else None) for i, _, h, _ in pages if i is not None
    )
    assert [r.record_type for r in found if r.page_id is None] == ["response"]
    keys = [(r.url_key, r.captured) for r in found]
    assert keys == sorted(keys) and len({r.archive for r in found}) > 1
    assert archives.archived(frame.limit(0), str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("runs", [[], [[]], [[3, 1]], [[1, 4], [], [1, 2, 9]], [[5], [1], [3], [2], [4]]])
def test_loser_tree(runs):
    made = [sorted(r) for r in runs]
    assert list(archives.LoserTree(made, lambda x: (x,))) == sorted(x for r in runs for x in r)


def test_url_filter(spark):
    urls = ["http://A.Example.ORG/es/1", "https://x.org", "http://example.org/en/12?x", "http://b.com/de/1#t", None, "nothing", "http://corg/fr/", "http://b.com/de"]
    pages = [(i, u, "h") for i, u in enumerate(urls)] + [(100 + i, f"http://s.net/{'bad' if i % 2 else 'good'}/{i}.html", "h") for i in range(120)]
    frame = spark.createDataFrame(pages, "page_id long, url string, template string")
    labels = spark.createDataFrame([(100 + i, i % 2 == 1) for i in range(100)], "page_id long, bad boolean")
    rules = [path_templates.Rule("org/", True), path_templates.Rule("example.org/es/", False), path_templates.Rule("com/de/", False)]
    found = {r.page_id: r for r in path_templates.filtered_urls(frame, labels, rules).collect()}
    assert [(found[i].host, found[i].path, found[i].rule, found[i].verdict) for i in range(8)] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("x.org", "", None, "allow"), ("example.org", "/en/12", "org/", "allow"),
        ("b.com", "/de/1", "com/de/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("corg", "/fr/", None, "allow"), ("b.com", "/de", None, "allow"),
    ]
    assert all(found[100 + i].verdict == ("block" if i % 2 else "allow") for i in range(120))
    assert {found[100 + i].template for i in range(120)} == {"s.net/bad/<n>.html", "s.net/good/<n>.html"}
    assert path_templates.filtered_urls(frame.limit(0), labels, rules).count() == 0


def judged_paths(spark, paths, **settings):
    """{path: (template, rejected)} of (path, bad) on one host."""
    frame = spark.createDataFrame([("h.net", p, b) for p, b in paths], "host string, path string, bad int")
    return {r.path: (r.template, r.rejected) for r in path_templates.templates(frame, **settings).collect()}


def test_small_sections_of_a_hot_host_are_judged_by_themselves(spark):
    """One bad section of 60, each with less than 2 % of the host's pages, by name and by number."""
    paths = [(f"/part-{'abcdef'[s // 10]}{'abcdefghij'[s % 10]}/{i}", int(s == 7)) for s in range(60) for i in range(30)]
    found = judged_paths(spark, paths)
    assert {p for p, (_, rejected) in found.items() if rejected} == {p for p, bad in paths if bad}
    assert found["/part-ah/3"][0] == "h.net/part-ah/<n>" and found["/part-aa/3"][0] == "h.net/*/<n>"
    paths = [(f"/{s}/{i}", int(s == 5)) for s in range(60) for i in range(30)]
    found = judged_paths(spark, paths)
    assert {p for p, (_, rejected) in found.items() if rejected} == {p for p, bad in paths if bad}
    assert found["/5/1"][0] == "h.net/5/<n>" and found["/6/1"][0] == "h.net/<n>/<n>"


def test_deep_branches_are_told_apart(spark):
    deep = "/a" * 12
    paths = [(f"{deep}/{'bad' if i % 2 else 'good'}/{i}", i % 2) for i in range(80)] + [("/b" * 300, None)]
    found = judged_paths(spark, paths)
    assert {p for p, (_, rejected) in found.items() if rejected} == {p for p, bad in paths if bad}
    assert found["/b" * 300][0].endswith("/<s>" * 280) and found["/b" * 300][0].count("/") == 300


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 64) for _ in range(200)]
    rows = packing.best_fit(np.asarray(lengths), 64)
    assert sorted(i for r in rows for i in r) == list(range(200))
    assert sorted(sum(lengths[i] for i in r) for r in rows) == sorted(sum(lengths[i] for i in r) for r in brute.best_fit(lengths, 64))


def test_the_encoder_keeps_no_words():
    """Words that never come again, of which a corpus has the most, leave nothing behind in a task."""
    encode = packing.Encoder(packing.VOCABULARY)
    before = len(pickle.dumps({k: v for k, v in vars(encode).items() if k != "plain"}))
    for i in range(200):
        text = " ".join(f"w{i}x{j}" for j in range(50))
        assert np.frombuffer(encode(text), encode.kind).tolist() == encode.plain.encode_ordinary(text)
    assert len(pickle.dumps({k: v for k, v in vars(encode).items() if k != "plain"})) == before


def test_packing_round_trip(docs, rows, none):
    found = packing.packed_sequences(docs, length=256, block_tokens=3000).collect()
    encode = packing.Encoder(packing.VOCABULARY)
    pieces = {}
    for r in found:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == 256 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens :].any()
        for doc, start, a, b in zip(r.doc_ids, r.piece_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            pieces.setdefault(doc, []).append((start, ids[a:b].tolist()))
    for i, text, *_ in rows:
        ids = [t for _, x in sorted(pieces.get(i, []))[:: 2 if i == 5 else 1] for t in x]  # document 5 occurs twice
        assert encode.plain.decode(ids) == (text or "")
        assert np.frombuffer(encode(text or ""), "<u2").tolist() == encode.plain.encode_ordinary(text or "")
    assert packing.packed_sequences(none).count() == 0


def test_decontamination(spark, docs, rows, none):
    items = [(1, rows[0][1][30:200]), (2, "One, TWO"), (3, None), (4, "..."), (5, "nowhere at all found"), (6, rows[0][1][30:200]), (None, "one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in decontamination.contamination(docs, benchmark).collect())
    assert found == sorted((r[0], *brute.contaminated(r[1], [x for x in items if x[0] is not None])) for r in rows)
    assert decontamination.contamination(none, benchmark).count() == 0
    assert decontamination.contamination(docs, benchmark.limit(0)).where("contaminated").isEmpty()
    assert decontamination.clean(docs, benchmark).columns == docs.columns


def test_windows_cut_off_by_the_end_of_a_text_and_repeated_rows(spark):
    item = prose(30, 45)
    words = item.split()
    rows = [(1, " ".join(words[:12])), (2, " ".join(words[17:])), (3, "so " + " ".join(words[18:])), (4, " ".join(words[:13]))]
    rows += [(None, f"{item} and {item}")] * 40
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(map(repr, (tuple(r) for r in decontamination.contamination(docs, benchmark).collect())))
    assert found == sorted(repr((r[0], *brute.contaminated(r[1], [(1, item)]))) for r in rows)
    worded = docs.selectExpr("doc_id", "xxhash64(text) as text_hash", "split(lower(text), ' ') as words")
    starts = {r.doc_id: [c.start for c in r.starts] for r in decontamination.candidates(worded, benchmark).collect()}
    assert 1 not in starts and 3 not in starts and len(starts[None]) == 2 * 18 and len(starts[2]) == len(starts[4]) == 1


def test_clean_documents_of_a_contaminated_id_stay(spark):
    item = prose(30, 41)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (None, prose(50, 42)), (None, None), (7, item), (7, prose(50, 43)), (8, prose(50, 44)), (8, prose(50, 44))]
    found = decontamination.clean(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(r) for r in rows if r[1] != item)


def test_language(spark):
    words = {"xa": "kalo mine sura tak", "xb": "bron chet wulf drag", "xc": "äö üß ñé çà"}
    texts = [(i, " ".join(random.Random(i).choices(words[lang].split(), k=20)), lang, 1.0) for i, lang in enumerate(["xa", "xb", "xc"] * 60)]
    extra = [(500, None, "xa", 1.0), (501, "123 ..", "xa", 1.0), (502, "", None, 1.0), (503, "kalo mine " * 200000, None, 1.0)]
    docs = spark.createDataFrame(texts + extra, "doc_id long, text string, lang string, score double")
    model = language_id.fit(docs)
    found = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(found[i].lang_pred == lang and 0 <= found[i].score <= 1 for i, _, lang, _ in texts)
    assert [(found[i].lang_pred, found[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3 and found[503].lang_pred == "xa"
    assert language_id.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_long_texts_have_the_grams_of_one_piece(monkeypatch):
    text = prose(300, 3)
    whole = list(language_id._counts([text]))
    monkeypatch.setattr(language_id, "BLOCK", 100)
    cut = list(language_id._counts([text]))
    assert [n for n, *_ in cut] == [0] and (cut[0][0] == whole[0][0])
    assert dict(zip(cut[0][1].tolist(), cut[0][2].tolist())).keys() == dict(zip(whole[0][1].tolist(), whole[0][2].tolist())).keys()


def test_cut_texts_count_once_in_document_frequencies(monkeypatch):
    texts = [prose(20, 1), prose(400, 2), "", prose(300, 3), prose(5, 4), None, *[prose(3, i) for i in range(70)], prose(90, 5)]

    def frequencies():
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        (out,) = language_id._document_frequencies(iter([batch]))
        return dict(zip(*[column.to_pylist() for column in out.columns]))

    whole = frequencies()
    assert whole[-1] == len(texts)
    monkeypatch.setattr(language_id, "BLOCK", 100)
    assert frequencies() == whole


def test_the_training_sample_is_bounded_for_null_ids_and_copies(spark):
    apart = spark.range(4000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id) as text", "'xa' as lang")
    copies = spark.range(4000).selectExpr("7L as doc_id", "'the same' as text", "'xa' as lang")
    one_id = spark.range(4000).selectExpr("8L as doc_id", "concat('other ', id) as text", "'xa' as lang")
    train = apart.unionByName(copies).unionByName(one_id)
    assert 600 < language_id.sampled(train, 12000, 1200).count() < 1000
    assert language_id.sampled(train, 12000, 12000).count() == 8001


def test_importance(spark, none):
    texts = [(i, prose(40, i) if i % 4 else " ".join(["foul"] * 20 + [prose(10, i)]), "o") for i in range(200)]
    docs = spark.createDataFrame(texts + [(None, None, "o"), (900, "", "o")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 200, 2)] + [(0, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in importance.resampled(docs, labels).collect()}
    assert len(found) == 202 and found[900].log_weight == 0
    assert not any(found[i].kept for i in range(0, 200, 4))
    assert importance.resampled(none, labels).count() == 0
    assert all(r.kept for r in importance.resampled(docs, labels.limit(0)).collect())


def test_importance_weights_equal_plain_counts(spark):
    pick, words = random.Random(11), [f"w{i}" for i in range(12)]
    texts = {i: " ".join(pick.choices(words[:6] if i % 3 else words, k=i % 50)) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    good = {i for i in range(0, 300, 2) if i % 3 and i % 7}

    def parts(text):
        ws = text.split()
        return ws, list(zip(ws, ws[1:]))

    ratios = []
    for k in (0, 1):
        raw, target = Counter(), Counter()
        for i, text in texts.items():
            raw.update(parts(text)[k])
            target.update(parts(text)[k] if i in good else ())
        share = sum(target.values()) / sum(raw.values())
        plain = {w: math.log((target[w] + 0.5) / (raw[w] * share + 0.5)) for w in raw}
        error = {w: 1.645 * math.sqrt(1 / (target[w] + 0.5) + 1 / (raw[w] * share + 0.5)) for w in raw}
        ratios.append({w: math.copysign(max(0, abs(v) - error[w]), v) for w, v in plain.items()})
    found = {r.doc_id: r.log_weight for r in importance.resampled(docs, labels).collect()}
    assert any(v for r in ratios for v in r.values())
    for i, text in texts.items():
        expected = sum(ratio[w] for ratio, part in zip(ratios, parts(text)) for w in part)
        assert found[i] == pytest.approx(expected, abs=1e-4)


def test_few_foul_words_in_long_texts_weigh_down(spark):
    """Two words of five in texts of sixty: the draw prefers texts without them, labelled or not."""
    foul = ["foul", "vile", "rotten", "nasty", "grim"]
    texts = []
    for i in range(2000):
        ws = prose(60, i).split(" ")
        if i % 10 == 0:
            ws[7], ws[40] = foul[i // 10 % 5], foul[i // 50 % 5]
        texts.append((i, " ".join(ws)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(0, 2000) if i % 20 < 10], "doc_id long, quality int, toxic int")
    rows = importance.resampled(docs, labels).collect()
    kept = {dirty: [r.kept for r in rows if (r.doc_id % 10 == 0) == dirty and r.doc_id % 20 >= 10] for dirty in (True, False)}
    assert sum(kept[True]) <= 0.2 * len(kept[True]) and sum(kept[False]) >= 0.9 * len(kept[False])


def test_gumbel_top_k_takes_the_largest_keys(spark):
    weights = spark.range(1000).selectExpr("id as doc_id", "cast(id % 10 as double) as log_weight")
    found = importance.gumbel_top_k(weights, 137).collect()
    top = sorted(found, key=lambda r: -r.draw_key)
    assert sum(r.kept for r in found) == 137 and all(r.kept for r in top[:137])


def test_mixing(spark, none):
    rows = [(i, prose(20, i), "big" if i % 10 else "small") for i in range(2000)] + [(None, "a b", None), (7000, None, "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = mixing.source_tokens(docs)
    weights = {r.source: r for r in mixing.mixture(tokens, 0.95, 3.0, 1.0).collect()}
    assert sum(r.weight for r in weights.values()) == pytest.approx(1)
    assert all(r.epochs <= 3 for r in weights.values()) and weights["small"].weight > weights["small"].share
    drawn = mixing.mixed(docs, 0.95, 3.0).collect()
    for name in ("big", "small"):
        budget = weights[name].epochs * weights[name].tokens
        assert sum(r.tokens for r in drawn if r.source == name) == pytest.approx(budget, rel=0.02)
    times = {}
    for r in drawn:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    low = math.floor(weights["small"].epochs)
    assert {n for i, n in times.items() if i is not None and i % 10 == 0} <= {low, low + 1}
    assert mixing.drawn_documents(docs).columns == docs.columns and mixing.mixed(none).count() == 0


def test_near_duplicates(docs, rows, none):
    groups = brute.near_components([(r[0], r[1]) for r in rows])
    found = set_join.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == groups
    assert all(r.n_shingles == len(brute.shingle_set(rows[r.doc_id][1])) and r.kept == (groups[r.doc_id] == r.doc_id) for r in found)
    assert set_join.near_duplicates(none).count() == 0
    assert set_join.first_of_each_group(docs).columns == docs.columns


@pytest.mark.parametrize("limit, most", [("BLOCK_TOKENS", 3000), ("BLOCK_CLASSES", 15)])
def test_large_groups_in_blocks(spark, monkeypatch, limit, most):
    """A dense node is closed at once, and blocks of a group lose no link."""
    monkeypatch.setattr(set_join, limit, most)
    base = prose(200, 11)
    rows = [(i, edited(base, 60 + i % 40, 100 + i)) for i in range(60)] + [(100 + i, prose(30, 500 + i)) for i in range(20)]
    found = set_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.near_components(rows)


def test_rule_votes(docs, rows, none):
    found = rule_votes.judged(docs).collect()
    for r in found:
        counts = brute.base_counts(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    assert len(found) == len(rows) and rule_votes.judged(none).count() == 0


def test_em_finds_broken_rules():
    rng, patterns = random.Random(3), {}
    truth = []
    for _ in range(3000):
        good = rng.random() < 0.85
        votes = tuple(-1 if rng.random() < (0.01 if good else 0.5) else 1 for _ in range(6))
        truth.append((good, votes))
        patterns[votes] = patterns.get(votes, 0) + 1
    model = rule_votes.estimate(patterns)
    right = sum((model.posterior(v) >= 0.5) == g for g, v in truth) / len(truth)
    assert right > 0.95 and 0.75 < model.prior < 0.95
