"""The training-text operators on small cases, against brute force, and on awkward tables."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.llm import bigru, language, leakage, lookalikes, mixing, pagelib, pages, quality, repair, repetition, spam
from vellum.llm.queries import queries
from vellum.llm.textnorm import skeleton

QUERIES = queries()


def lines(page, texts, volume=1, at="2024-01-01"):
    import datetime

    t = datetime.datetime.fromisoformat(at)
    return [{"line_uid": page * 1000 + i, "page_id": page, "volume_id": volume, "line_pos": i, "text": x, "recognised_at": t} for i, x in enumerate(texts)]


def abc(n):
    """A word of letters for a number."""
    return "".join("abcdefghij"[int(c)] for c in str(n))


def pages_of(rows):
    return [{"page_id": p, "volume_id": v} for p, v in {(r.get("page_id"), r.get("volume_id")) for r in rows} if p is not None]


# ---------------------------------------------------------------- text forms
def test_skeleton():
    assert skeleton("Ｓаlе ﬁ 𝗍𝖺𝗅 x​y ä a b c‐d") == "Sale fi tal xy ä a b c-d"
    assert skeleton("") == "" and skeleton("5") != skeleton("S") and skeleton("a") != skeleton("A") != skeleton("Ä")


@given(st.text(max_size=30))
def test_skeleton_is_stable(t):
    assert skeleton(skeleton(t)) == skeleton(t)


def test_look_alike_pairs(spark, write_tables):
    texts = ["Den sale book of the year", "Den sаle book of the year", "Den sale book of the year", "Den Sale book of the year", "short", None, "", "x" * 20000]
    rows = lines(1, texts) + lines(1, ["Den sale bооk of the year, older"], at="2020-01-01")
    d = write_tables(line_texts=rows + rows[:2])
    assert {tuple(r) for r in lookalikes.p5_found(spark, d).collect()} == {(1000, 1001), (1001, 1002)}
    assert {(r.line_uid, r.class_uid, r.look_uid, r.n_texts) for r in lookalikes.p5_classes(spark, d).collect()} == {(1000, 1000, 1000, 2), (1002, 1000, 1000, 2), (1001, 1001, 1000, 2)}


def test_many_copies_keep_their_links(spark, write_tables, monkeypatch):
    monkeypatch.setattr(lookalikes, "PAIRED", 3)
    rows = [{**r, "line_uid": r["line_uid"]} for p in range(8) for r in lines(p, ["the same text for all of us"])] + lines(99, ["the sаme text for all of us"])
    got = lookalikes.p5_found(spark, write_tables(line_texts=rows)).collect()
    assert {r.uid_a for r in got} | {r.uid_b for r in got} >= {p * 1000 for p in range(8)} | {99000}


def test_many_spellings_give_a_row_a_line(spark, write_tables):
    marks = ["".join("\u200b" if k >> b & 1 else "" for b in range(9)) for k in range(200)]
    texts = [f"the same text{'\u200b' * k} for all of us" for k in range(len(marks))]
    got = lookalikes.p5_found(spark, write_tables(line_texts=lines(1, texts))).collect()
    assert len(got) <= len(texts) and {u for r in got for u in r} == {1000 + k for k in range(len(texts))}
    root = {u: u for r in got for u in r}
    for _ in range(3):
        for a, b in map(tuple, got):
            root[a] = root[b] = min(root[a], root[b])
    assert set(root.values()) == {1000}


# ---------------------------------------------------------------- pages
def test_repeated_share():
    ws = "a b c d".split() * 5 + [f"w{i}" for i in range(20)]
    assert pagelib.repeated_share(ws) == pytest.approx(16 / 40)
    assert pagelib.repeated_share([]) == 0 and pagelib.repeated_share("a b c d a b c d".split()) == 0


def test_furniture_and_words():
    page = pagelib.Page([(0, "12 Rundesund Domböcker"), (1, "och han till=  "), (2, "baka gick"), (3, None), (4, "fol. 3r")], ["rundesund domböcker"])
    assert page.skip == {0, 4} and page.words() == ["och", "han", "tillbaka", "gick"]
    near = pagelib.Page([(0, "Rundesunb Dornböcker 1848-1852"), (1, "a"), (2, "b"), (3, "c"), (4, "§ 14")], ["rundesund domböcker"])
    assert near.skip == {0}
    assert pagelib.Page([], []).words() == [] and pagelib.Page([(0, None)], []).kind() == "prose"


def test_kinds():
    prose = [(i, "the old man went to the farm. Then he saw that it was") for i in range(8)]
    table = [(i, "12   3,40   7   1") for i in range(8)]
    junk = [(i, "¤¥ qx#¶ %&/ {[ =}") for i in range(8)]
    listed = [(i, f"{i}. red horse") for i in range(8)]
    assert [pagelib.Page(p, []).kind() for p in (prose, table, junk, listed)] == ["prose", "table", "junk", "list"]


def test_corrections():
    forms = {"vanha": 900, "mukaan": 500, "rnen": 1, "men": 400, "vik": 40, "rik": 300}
    assert pagelib.correct("vanba", 1, forms) == "vanha" and pagelib.correct("mulcaan", 2, forms) == "mukaan" and pagelib.correct("rnen", 1, forms) == "men"
    assert pagelib.correct("vik", 40, forms) is None and pagelib.correct("vanha", 900, forms) is None
    for a, b in (("vanba", "vanha"), ("mulcaan", "mukaan"), ("rnen", "men"), ("kуlä", "kуlä")):
        assert pagelib.glyph_skeleton(a) == pagelib.glyph_skeleton(b)
    assert pagelib.repaired("Vanba,", "vanba", "vanha") == "Vanha," and pagelib.repaired("viilillä", "viilillä", "välillä") == "välillä"
    assert pagelib.digit_word("ta1ona") and not pagelib.digit_word("21r") and not pagelib.digit_word("147½")


def test_noise_and_reflow(spark, write_tables):
    who = "smith miller tailor sailor judge priest soldier widow maid servant bailiff sexton".split()
    body = [[f"the {w} walked to the village", f"and {w} walked out, so the vil-", "lage was old. The farmer", "walked in the village winter-", f"and summer of {w}.", f"{p}"] for p, w in enumerate(who)]
    body[3][0] = "the sailor walkcd to the village"
    rows = [x for p, b in enumerate(body) for x in lines(p, b)]
    extra = lines(0, ["older"], at="2020-01-01")
    d = write_tables(line_texts=rows + extra, pages=pages_of(rows))
    got = {tuple(r) for r in repair.p6_found(spark, d).collect()}
    assert got == {(p, 5, "furniture") for p in range(12)} | {(p, 1, "hyphen") for p in range(12)} | {(3, 0, "misread")}
    text = repair.p6_paragraphs(spark, d).filter("page_id = 3").orderBy("para_no").first().text
    assert text == "the sailor walked to the village and sailor walked out, so the village was old. The farmer walked in the village winter- and summer of sailor."


def test_exact_ranks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice("st"), float(rng.choice([0, 0, 0, 1, 2, 3.5]))) for _ in range(500)] + [("a", "s", None)]
    got = {(r.grp, r.stat, r.value): (r.below, r.upto, r.total) for r in quality.exact_ranks(spark.createDataFrame(rows, "grp STRING, stat STRING, value DOUBLE")).collect()}
    for g, s, v in {r for r in rows if r[2] is not None}:
        own = [r[2] for r in rows if r[:2] == (g, s) and r[2] is not None]
        assert got[g, s, v] == (sum(x < v for x in own), sum(x <= v for x in own), len(own))


def test_common_kinds_are_found(spark, write_tables):
    rng = random.Random(4)
    names = [a + b for a in "kar mal tor vil sand".split() for b in "by sund berg lax holm".split()]
    prose = [[f"the {rng.choice(names)} went to the farm. Then he saw that {rng.choice(names)} was in it" for _ in range(8)] for _ in range(10)]
    listed = [[f"{i}. {rng.choice(names)} {rng.choice(names)}" for i in range(8)] for _ in range(10)]
    tables = [["   ".join(str(rng.randrange(1000)) for _ in range(4)) for _ in range(8)] for _ in range(10)]
    rows = [x for p, texts in enumerate(prose + listed + tables) for x in lines(p, texts)]
    d = write_tables(line_texts=rows, pages=pages_of(rows))
    assert {tuple(r) for r in quality.p4_found(spark, d).collect()} == {(p, "list") for p in range(10, 20)} | {(p, "table") for p in range(20, 30)}
    assert {"junk_score", "table_score", "list_score"} <= set(quality.p4_statistics(spark, d).columns)


def test_the_verdict_comes_from_the_ranks(spark, small, monkeypatch):
    assert quality.p4_found(spark, small).count() > 0
    # without the tails nothing is out of the ordinary
    monkeypatch.setattr(quality, "tail_scores", lambda stats: stats.select("page_id", *(F.lit(0.0).alias(f"{s}_{x}") for s in quality.RANKED for x in ("low", "high"))))
    assert quality.p4_found(spark, small).count() == 0


def test_ranks_count_reference_rows_only(spark):
    rows = [("a", "s", float(v), v % 2 == 0) for v in range(10)]
    got = {r.value: (r.below, r.upto, r.total) for r in quality.exact_ranks(spark.createDataFrame(rows, "grp STRING, stat STRING, value DOUBLE, ref BOOLEAN")).collect()}
    assert got == {float(v): ((v + 1) // 2, v // 2 + 1, 5) for v in range(10)}


# ---------------------------------------------------------------- language
def test_gradients():
    net = bigru.BiGRU(3, hidden=4, seed=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, n = bigru.padded(bigru.encode(["abc de", "xy", "längre"]))
    y = np.array([0, 2, 1])
    _, grads = net.loss_and_grads(x, n, y)
    rng = np.random.default_rng(0)
    for name in net.w:
        flat = net.w[name].reshape(-1)
        for i in np.flatnonzero(np.abs(grads[name].reshape(-1)) > 1e-4)[rng.integers(0, 1 << 30, 4) % max(1, (np.abs(grads[name]) > 1e-4).sum())]:
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up = net.loss_and_grads(x, n, y)[0]
            flat[i] = old - eps
            down = net.loss_and_grads(x, n, y)[0]
            flat[i] = old
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / 2 / eps, rel=0.05, abs=2e-4)


def test_pooled_equals_the_training_pass():
    net = bigru.BiGRU(3, hidden=5, seed=1)
    texts = ["abc", "", "räksmörgås på bordet", "x"]
    x, n = bigru.padded(bigru.encode(texts))
    y, _ = net._logits(x, n)
    p = y - y.max(axis=2, keepdims=True)
    p -= np.log(np.exp(p).sum(axis=2, keepdims=True))
    want = (p * (np.arange(len(x))[:, None] < n)[:, :, None]).sum(axis=0) / np.maximum(n, 1)[:, None]
    assert net.pooled(texts, batch=2) == pytest.approx(want, abs=1e-4)


def test_stretches_against_all_splits():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(10, 16))
        logp = np.log(rng.dirichlet(np.ones(3) * 0.5, size=n) + 1e-3)
        e = np.maximum(logp, -5.0)

        def best(a):
            whole = max(e[a:].sum(axis=0))
            out = [whole] if n - a >= language.LEAST else []
            for b in range(a + language.LEAST, n - language.LEAST + 1):
                out.append(max(e[a:b].sum(axis=0)) - language.SWITCH + best(b))
            return max(out) if out else -np.inf

        cuts = language._viterbi(e)
        score = sum(e[a:b, k].sum() for a, b, k in cuts) - language.SWITCH * (len(cuts) - 1)
        assert all(b - a >= language.LEAST for a, b, _ in cuts) and [a for a, _, _ in cuts[1:]] == [b for _, b, _ in cuts[:-1]]
        assert score >= best(0) - 1e-9


def test_held_out_language_accuracy(spark, small):
    rows = [(r.text, r.label) for r in language.training_lines(spark, "/root/testdata/sf0.01").collect()]
    random.Random(0).shuffle(rows)
    cut = len(rows) * 4 // 5
    net = language.train([t for t, _ in rows[:cut]], [k for _, k in rows[:cut]])
    q = net.pooled([language.fold(t) for t, _ in rows[cut:]]).argmax(axis=1)
    right = np.mean([language.LANGUAGES[a] == k for a, (_, k) in zip(q, rows[cut:])])
    assert right > 0.7  # some labels are wrong, and some pages hold several languages


# ---------------------------------------------------------------- leakage
def brute_leaks(docs, items):
    out = {}
    for d, t in docs:
        runs = leakage.runs(t)
        s, ends = "".join(runs), np.cumsum([len(r) for r in runs]).tolist()
        begins, ends = {0, *ends}, set(ends)
        for i, u in items:
            x, b, e = leakage.item_words(u)
            for k in range(len(b)):
                for m in range(k + leakage.MATCH - 1, len(b)):
                    part, at = x[b[k] : e[m]], -1
                    while (at := s.find(part, at + 1)) >= 0:
                        if at in begins and at + len(part) in ends:
                            out[d, i] = max(out.get((d, i), 0), m - k + 1)
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30))
def test_matches_against_brute_force(seed):
    r = random.Random(seed)
    some = lambda n: [r.choice("a b ab ba abc c cab bc".split()) for _ in range(n)]
    items = [(i, " ".join(some(r.randint(5, 40)))) for i in range(4)]
    docs = []
    for d in range(5):
        words = some(r.randint(0, 20))
        for _ in range(r.randint(0, 3)):
            own = r.choice(items)[1].split()
            words += own[(a := r.randint(0, len(own) - 1)) : a + r.randint(5, 20)] + some(r.randint(0, 3))
        docs.append((d, "".join(w + r.choice([" ", " ", ", ", "-\n", "—", "/", ""]) for w in words)))
    docs = [(d, t) for d, t in docs if t]
    runs = [leakage.runs(t) for _, t in docs]
    got = leakage.Items(items).matches([d for d, _ in docs], ["".join(x) for x in runs], [np.array([len(y) for y in x]) for x in runs])
    assert {(d, i): n for d, i, n, _, _ in got} == brute_leaks(docs, items)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(2)
    c = np.concatenate([rng.integers(-1, 4, 3000), [-1] * 16]).astype(np.int32)
    at = leakage.suffix_array(c, np.arange(3000), 13)
    keys = [tuple(c[a : a + 13]) for a in at]
    assert keys == sorted(keys) and all(min(k) > 0 for k in keys) and len(keys) == sum(min(c[a : a + 13]) > 0 for a in range(3000))


@pytest.mark.parametrize("joint", [",", "—", "/", " ", "-\n", "¬\n"])
def test_punctuation_spacing_and_cut_words_on_either_side(spark, write_tables, joint):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen village".split()
    plain, broken = " ".join(words), joint.join(words[:-1]) + " vil-\nlage"
    d = write_tables(documents=[{"doc_id": 1, "text": plain}, {"doc_id": 2, "text": broken}, {"doc_id": 3, "text": " ".join(words[2:])}], benchmark=[{"item_id": 7, "text": broken}, {"item_id": 8, "text": plain}])
    want = {(1, 8, 14), (2, 8, 14)} | ({(1, 7, 15), (2, 7, 15)} if joint == " " else set())
    assert {tuple(r)[:3] for r in leakage.p7_matches(spark, d).collect()} >= want


def test_items_in_parts(spark, write_tables, monkeypatch):
    monkeypatch.setattr(leakage, "ITEM_LETTERS", 50)
    item = "One two three four five six seven eight nine ten eleven twelve thirteen number"
    d = write_tables(documents=[{"doc_id": k, "text": f"{item}{k}."} for k in range(4)], benchmark=[{"item_id": k, "text": f"{item}{k}"} for k in range(4)])
    assert {tuple(r)[:3] for r in leakage.p7_matches(spark, d).collect()} == {(a, b, 14 if a == b else 13) for a in range(4) for b in range(4)}


def test_leaks(spark, write_tables):
    item = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    broken = "x. ONE two, three four five\nsix sev-\nen eight nine tеn eleven twelve thirteen. y"
    d = write_tables(documents=[{"doc_id": 1, "text": broken}, {"doc_id": 2, "text": "one two three"}, {"doc_id": 3, "text": None}, {"doc_id": 4, "text": item}, {"doc_id": 5, "text": item}], benchmark=[{"item_id": 7, "text": item}, {"item_id": 8, "text": None}, {"item_id": 9, "text": item}])
    assert {tuple(r) for r in leakage.p7_found(spark, d).collect()} == {(a, b) for a in (1, 4, 5) for b in (7, 9)}
    assert {r.doc_id for r in leakage.p7_clean(spark, d).collect()} == {2, 3}


# ---------------------------------------------------------------- mixing
@given(st.integers(1, 5000), st.integers(0, 50))
@settings(max_examples=40, deadline=None)
def test_permutation(n, key):
    assert sorted(mixing.permute(np.arange(n), n, key).tolist()) == list(range(n))


@pytest.mark.parametrize("counts", [[5000, 300, 0, 12], [3], [10**12, 5 * 10**11, 7]])
def test_shards_add_up(counts):
    tree = mixing.Shards(counts)
    assert tree.shards == math.ceil(sum(counts) / mixing.SHARD_BLOCKS)
    at = np.zeros(len(counts), dtype=np.int64)
    for k in range(min(tree.shards, 50)):
        drawn, first = tree.of(k)
        assert drawn.sum() == (mixing.SHARD_BLOCKS if k < tree.shards - 1 else sum(counts) - (tree.shards - 1) * mixing.SHARD_BLOCKS) and (drawn >= 0).all() and (first == at).all()
        at += drawn
    if tree.shards <= 50:
        assert at.tolist() == counts
    # a shard's counts don't depend on which shards were asked for before
    last = tree.shards - 1
    assert all((a == b).all() for a, b in zip(mixing.Shards(counts).of(last), tree.of(last)))


def test_draws_are_multinomial():
    tree = mixing.Shards([60_000, 30_000, 10_000])
    drawn = np.array([tree.of(k)[0] for k in range(tree.shards - 1)])
    want = mixing.SHARD_BLOCKS * np.array([0.6, 0.3, 0.1])
    assert np.abs(drawn.mean(axis=0) - want).max() < 8 and 0.5 < drawn[:, 0].var() / (want[0] * 0.4) < 1.6


def test_mix(spark, write_tables):
    docs = [{"doc_id": i, "text": f"word{i} is here " * 90, "source": s} for i, s in enumerate([" A "] * 60 + ["b"] * 25 + ["c"] + [None, "zz"])] + [{"doc_id": 990, "text": None, "source": "a"}, {"doc_id": 991, "text": "", "source": "b"}]
    targets = [{"source": "a", "target_share": 0.5, "max_repeats": 1}, {"source": "b", "target_share": 0.3, "max_repeats": 3}, {"source": "c", "target_share": 0.1, "max_repeats": 3}, {"source": "none", "target_share": 0.1, "max_repeats": 2}]
    d = write_tables(documents=docs, mix_targets=targets)
    got = {r.source: r for r in mixing.p8_shares(spark, d).collect()}
    assert got["none"].tokens == 0 and got["a"].most_used == 1 and got["b"].most_used <= 3
    assert got["a"].budget_share == pytest.approx(0.5, abs=0.02) and got["b"].budget_share == pytest.approx(0.3, abs=0.02)
    # a source under a block takes part; it falls short of its share, used as often as it may
    assert 0 < got["c"].tokens_available < mixing.BLOCK and got["c"].tokens == 3 * got["c"].tokens_available and got["c"].most_used == 3
    mix = mixing.p8_mix(spark, d, budget=8000)
    assert mix.agg(F.sum("n_tokens")).first()[0] == pytest.approx(0.8 * 8000 + got["c"].tokens, abs=2 * mixing.BLOCK)
    assert mix.groupBy("doc_id", "from_token").count().agg(F.max("count")).first()[0] <= 3


def test_mix_carries_its_tokens(spark, write_tables):
    docs = [{"doc_id": i, "text": f"word{i} is here " * (90 + i), "source": "a"} for i in range(30)]
    docs += [docs[3], {**docs[4], "text": "other text " * 200}, {"doc_id": 99, "text": "", "source": "a"}, {"doc_id": 98, "source": "a"}]
    d = write_tables(documents=docs, mix_targets=[{"source": "a", "target_share": 1.0, "max_repeats": 1}])
    encode = mixing._encoding(mixing.TOKENIZER).encode_ordinary
    ids = {}
    for x in docs:
        ids.setdefault(x["doc_id"], []).append(encode(x.get("text") or ""))
    mix = mixing.p8_mix(spark, d).collect()
    assert mix and all(len(r.tokens) == r.n_tokens and any(t[r.from_token : r.from_token + r.n_tokens] == r.tokens for t in ids[r.doc_id]) for r in mix)
    place = lambda r: (r.shard, r.slot_key, r.source, r.block, r["pass"], r.at_token, r.doc_id, r.from_token, r.n_tokens)
    assert sorted(map(place, mix)) == sorted(map(place, mixing.p8_pointers(spark, d).collect()))
    blocks = mixing.p8_blocks(spark, d).collect()
    total = sum(len(t) for ts in ids.values() for t in ts)
    assert sorted(len(r.tokens) for r in blocks)[1:] == [mixing.BLOCK] * (total // mixing.BLOCK) and sum(len(r.tokens) for r in blocks) == total


# ---------------------------------------------------------------- spam
def test_spam(spark, write_tables):
    words = "cheap maps copy order records scanning discount".split()
    rng = random.Random(3)
    stuffed = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    links = ["\n".join(f"[maps](https://a{i}.example/p/{j})" for j in range(20)) for i in range(3)]
    prose = " ".join(f"Then the farmer number{i} saw that horse{i * 7} was in field{i * 3}." for i in range(30))
    index = "\n".join(f"Name{i}, First{i * 3}, smith {i}" for i in range(30))
    refs = prose + "\n" + "\n".join(f"{i}) Name{i}, https://b{i}.example/" for i in range(1, 8))
    texts = [*stuffed, *links, prose, prose, index, refs, None, "", "x"]
    d = write_tables(documents=[{"doc_id": i, "text": t, "source": f"s{i % 4}", "volume_id": i} for i, t in enumerate(texts)])
    assert {r.doc_id for r in spam.p9_found(spark, d).collect()} == set(range(9))


def test_replication_finds_and_acquits(spark, write_tables):
    rng = random.Random(7)
    word = lambda k: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(k))
    sale = [word(3) for _ in range(6)]
    # a third strung keywords, the rest phrases that stand on other hosts as well
    shared = "\n".join(f"Then the {' '.join(word(4) for _ in range(4))} was in the {word(4)}." for _ in range(28))
    strung = " » ".join(f"{rng.choice(sale)} {rng.choice(sale)}" for _ in range(60))
    stitched = [f"{strung}\n{shared}" for _ in range(3)]
    # three fifths strung, but of words of its own
    own = lambda n: " ".join(word(4) for _ in range(n))
    alone = "\n".join([" » ".join(own(2) for _ in range(44)), *(f"Then the {own(3)} was in the {own(2)}." for _ in range(10))])
    texts = [*stitched, alone]
    d = write_tables(documents=[{"doc_id": i, "text": t, "source": "s", "volume_id": i} for i, t in enumerate(texts)])
    scores = {r.doc_id: r for r in spam.p9_scores(spark, d).collect()}
    assert all(0.25 < scores[i].dense < 0.5 and scores[i].replicated > 0.9 for i in range(3)) and 0.5 < scores[3].dense < 0.75 and scores[3].replicated == 0
    assert {r.doc_id for r in spam.p9_found(spark, d).collect()} == {0, 1, 2}
    # the same pages on one host: nothing stands elsewhere
    d = write_tables(documents=[{"doc_id": i, "text": t, "source": "s", "volume_id": 1} for i, t in enumerate(texts)])
    assert spam.p9_found(spark, d).count() == 0


def test_scores_against_brute_force(spark, write_tables, monkeypatch):
    monkeypatch.setattr(spam, "CHUNK_CHARS", 300)
    rng = random.Random(1)
    docs = [{"doc_id": i, "text": " ".join(rng.choice("abcdefg") * 2 for _ in range(rng.randint(1, 40))), "source": "s", "volume_id": rng.choice([1, 2, 3, None])} for i in range(60)]
    hosts: dict = {}
    sh = {x["doc_id"]: spam.read_document(x["text"])[1].tolist() for x in docs}
    for x in docs:
        for h in sh[x["doc_id"]]:
            hosts.setdefault(h, set()).add(x["volume_id"] or x["text"])
    got = {r.doc_id: (r.shingles, r.replicated) for r in spam.p9_scores(spark, write_tables(documents=docs)).collect()}
    want = {i: (len(h), sum(len(hosts[x]) > 1 for x in h) / max(1, len(h))) for i, h in sh.items()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def test_shingles_are_sets():
    a, b = np.array([1, 2, 1, 3, 2], dtype=np.uint64), np.array([3, 3, 2, 1, 1], dtype=np.uint64)
    assert spam.shingles(a) == spam.shingles(b) and len(spam.shingles(np.arange(9, dtype=np.uint64))) == 5
    assert len(spam.shingles(np.zeros(0, dtype=np.uint64))) == 0


# ---------------------------------------------------------------- awkward tables
@pytest.fixture(scope="module")
def empty(write_tables):
    return write_tables()


@pytest.fixture(scope="module")
def awkward(write_tables):
    rows = lines(1, [None, "", " ", "word " * 20000, "word " * 20000, "x"]) + lines(2, ["a b c d"] * 9) + lines(3, [None] * 6)
    rows += rows[:4] + [{"line_uid": None, "page_id": None, "text": "lost"}, {"page_id": 4, "text": "no place"}, {"page_id": 5, "line_pos": 0, "text": "no time or volume"}]
    docs = [{"doc_id": 1, "text": "word " * 40000, "source": "a"}, {"doc_id": 1, "text": "word " * 40000, "source": "a"}, {"doc_id": None, "text": "t", "source": "a"}, {"doc_id": 2}]
    return write_tables(
        extra="block STRING, n INT, word STRING, headers STRING, label INT, source_ STRING, grp INT", line_texts=rows, pages=pages_of(rows) + [{"page_id": 9}], volumes=[{"volume_id": 1}, {"title": "t"}], documents=docs,
        benchmark=[{"item_id": 1, "text": "word " * 30}, {}], mix_targets=[{"source": "a", "target_share": 1.0, "max_repeats": 2}, {}, {"source": "b"}], page_stats=[{"page_id": 1, "language": "xx"}, {"page_id": 2, "language": "fi"}, {"page_id": 2, "language": "fi"}, {}],
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_and_awkward_tables(spark, empty, awkward, name):
    assert QUERIES[name](spark, empty).count() == 0
    QUERIES[name](spark, awkward).collect()


def test_line_frequency_decides(spark, write_tables, monkeypatch):
    # a volume's formula fills a third of every page, four times each: it is the volume's, not the page's
    formula = "given under our hand and seal"
    rows = [x for p in range(6) for x in lines(p, [*[formula, f"then {abc(p)} came of men to town"] * 4, *(f"{abc(p)}x{abc(k)} {abc(p)}y{abc(k)}" for k in range(4))])]
    d = write_tables(line_texts=rows, pages=pages_of(rows))
    got = {r.page_id: r for r in repetition.page_repetition(spark, d).collect()}
    assert all(r.n_removed == 4 and r.repeated_share > 0.5 and not r.emptied for r in got.values())
    # a page with the formula alone as repetition
    rows = [x for p in range(6) for x in lines(p, [*[y for k in range(4) for y in (formula, f"{abc(p)}u{abc(k)} {abc(p)}v{abc(k)}")], *(f"{abc(p)}x{abc(k)} {abc(p)}y{abc(k)}" for k in range(4))])]
    d = write_tables(line_texts=rows, pages=pages_of(rows))
    assert repetition.p1_found(spark, d).count() == 0
    monkeypatch.setattr(pages, "HEADER_PAGES", 1000)
    assert {r.page_id for r in repetition.p1_found(spark, d).collect()} == set(range(6))


def test_all_lines_are_counted(spark, write_tables):
    rows = [x for p in range(5) for x in lines(p, ["one two", *[f"a{abc(p)}{abc(k)} b" for k in range(6)], "the common foot line 3"])]
    df = spark.read.parquet(write_tables(line_texts=rows) + "/line_texts.parquet")
    assert {r.key for r in pages.frequent_lines(df).collect()} == {"one two", "the common foot line"}


def test_repetitive_page_of_awkward_tables(spark, awkward):
    assert {r.page_id for r in repetition.p1_found(spark, awkward).collect()} == {1, 2}


def test_small_tables_give_the_stated_columns(spark, small):
    want = {"p1_found": ["page_id"], "p2_found": ["page_id", "first_pos", "lang"], "p4_found": ["page_id", "page_kind"], "p5_found": ["uid_a", "uid_b"], "p6_found": ["page_id", "line_pos", "noise"], "p7_found": ["doc_id", "item_id"], "p9_found": ["doc_id"]}
    for name, columns in want.items():
        df = QUERIES[name](spark, small)
        assert df.columns == columns and df.count() == df.distinct().count() > 0
