"""Edge cases and brute-force comparisons of the ten operators."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import ann, html_text, jaccard_join, labelled, language_id, mixing, packing, pii, quality_mil, queries, repetition, toxicity
from linkloom.llm.common import blocks, fold, hashed
from linkloom.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 977}" for k in range(60_000))
EDGE = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 4), (4, "one", "de", "b", 3), (4, "one", "de", "b", 3), (None, "no id here at all " * 20, "en", "a", 1),
    (6, LONG, "en", "a", len(LONG)), (7, LONG, "en", "a", len(LONG)), (8, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", "de", "b", 60), (9, "😀 　x", None, "c", 4), (10, "!!! ??? 123", "en", "a", 11),
]
EDGE[9] = (9, "\U0001f600 　x", None, "c", 4)


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, DOC)
    for clash in ("id", "c0", "cls", "row", "size", "taken", "score", "base", "print", "token", "copy", "digest"):  # names that operators use themselves
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def brute_repetition(text):
    words, lines, seen, dup = WORD.findall(text), text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = {j for k in range(len(words) - 2) if count[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
    had, covered = set(), set()
    for k in range(len(words) - 4):
        g = tuple(words[k : k + 5])
        if g in had:
            covered.update(range(k, k + 5))
        had.add(g)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeated), sum(len(words[k]) for k in covered)


def test_repetition(spark, sf, edge, empty):
    got = repetition.repetition_coverage(edge)
    assert got.count() == len(EDGE)
    r = rows_of(got)
    assert r[1]["n_words"] == 0 and r[1]["base_failed"] and not r[1]["kept"]
    assert r[6]["n_words"] == 60_000 and r[6]["base_failed"]
    assert repetition.repetition_coverage(empty).count() == 0
    texts = rows_of(documents(spark, sf))
    for k, x in rows_of(repetition.repetition_coverage(documents(spark, sf))).items():
        assert brute_repetition(texts[k]["text"]) == (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["dup_chars_5"])


def test_repetition_leaves_a_passage_said_twice(spark):
    own = " ".join(f"word{k}" for k in range(200))
    text = f"{own}\nthe same short line of eight words here\nand more text here\nthe same short line of eight words here"
    junk = " ".join(f"Ein{k // 20}" for k in range(200))
    r = rows_of(repetition.repetition_coverage(spark.createDataFrame([(1, text), (2, junk)], "doc_id long, text string")))
    assert r[1]["kept"] and not r[2]["kept"]


def test_hashes_tell_ranges_apart():
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 4, dtype=np.uint8)
    starts, ends = np.array([0, 26, 1, 0, 0]), np.array([20, 46, 21, 8, 9])
    h = hashed(data, starts, ends)
    assert h[0] == h[1] and len(set(h.tolist())) == 4
    one = list(blocks(pa.array(["ab", None, "", "c" * 50]), block_bytes=10))
    assert [b.n for b in one] == [3, 1]


def test_quality_learns_junk_from_bags(spark, sf, edge, empty):
    sample = []
    for k in range(120):
        clean = " ".join(f"word{(k * 7 + j) % 50} and" for j in range(150))
        sample.append((clean, 1))
        sample.append((clean + " JUNK!! $$$ ###" * 40, 0))
    model = quality_mil.fit(sample, steps=120)
    r = rows_of(quality_mil.score_quality(spark.createDataFrame([(1, sample[0][0]), (2, sample[1][0]), (3, None), (4, "")], "doc_id long, text string"), model))
    assert r[1]["score"] > 0.5 > r[2]["score"] and r[3]["score"] == r[4]["score"]
    assert quality_mil.score_quality(edge, model).count() == len(EDGE) and quality_mil.score_quality(empty, model).count() == 0
    one = quality_mil.fit([("a", 1)])
    assert rows_of(quality_mil.score_quality(edge, one))[1]["score"] == pytest.approx(2 / 3)


def auc(score, label):
    order = np.argsort(np.argsort(score))
    return (order[label == 1].mean() - order[label == 0].mean()) / len(score) + 0.5


def test_quality_on_held_out_rows(spark):
    big = "/root/testdata/sf0.01"
    got = queries.op2_quality_attention(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert auc(got.score.to_numpy(), got.quality.to_numpy()) > 0.97


def test_toxicity_on_held_out_rows(spark):
    big = "/root/testdata/sf0.01"
    got = queries.op9_toxicity_deobfuscated(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    hit = got[got.predicted == 1]
    assert auc(got.score.to_numpy(), got.toxic.to_numpy()) > 0.8 and (hit.toxic == 1).mean() > 0.9


def test_labels_are_learned_from_allowed_rows_only(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(60)], "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(70, 1), (3, None)], "doc_id long, quality int")
    got = labelled.labelled_sample(docs, marks, "quality", fold("doc_id", 3) != 1)
    allowed = {f"text {k}" for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1}
    assert {t for t, _ in got} == allowed


def test_deobfuscation(spark, edge, empty):
    lm = toxicity.smoothed(toxicity.count_trigrams(["you are an idiot and a stupid loser said the moron to the clown"] * 50))
    shown = {"1d10t": "idiot", "i d i o t": "idiot", "s.t.u.p.i.d": "stupid", "stuuuupid": "stupid", "l0ser": "loser", "m*ron": "moron"}
    for text, word in shown.items():
        assert word in toxicity.decode(text, lm)
    sample = [(f"you idiot stupid loser {k}", 1) for k in range(30)] + [(f"kind words of a friend {k}", 0) for k in range(90)]
    model = toxicity.fit(sample, lm)
    docs = spark.createDataFrame([(1, "you 1d10t, you l o s e r"), (2, "kind words of a friend"), (3, None)], "doc_id long, text string")
    r = rows_of(toxicity.score_toxicity(docs, model))
    assert r[1]["score"] > 0.7 > 0.3 > r[2]["score"]
    assert toxicity.score_toxicity(edge, model).count() == len(EDGE) and toxicity.score_toxicity(empty, model).count() == 0
    assert toxicity.language_model(empty).shape == (64, 64, 64)


def test_every_form_of_disguise_is_opened(spark):
    lm = toxicity.smoothed(toxicity.count_trigrams(["you are an idiot and a stupid loser said the moron to the clown with bitch and garbage"] * 50))
    sample = [(f"you idiot stupid loser moron clown bitch garbage {k}", 1) for k in range(30)] + [(f"kind words of a friend {k}", 0) for k in range(90)]
    model = toxicity.fit(sample, lm)
    forms = ["i d 1 o t", "i.d.1.0.t", "1 d 1 0 t", '"id1ot"', "(m0r0n)", "you-m0r0n", "idio7", "garbag#", "clown5", "8itch", "6arbage", "idioot", "i   d   i   o   t", "s-t-u-p-1-d", "1d10t", "m*ron", "s*t*u*p*i*d", "stuuuupid"]
    docs = spark.createDataFrame([(k, f"kind {f} of a friend") for k, f in enumerate(forms)] + [(99, "kind words of a friend")], "doc_id long, text string")
    r = rows_of(toxicity.score_toxicity(docs, model))
    assert not [f for k, f in enumerate(forms) if r[k]["score"] <= 0.5] and r[99]["score"] < 0.3


def brute_decode(shown, lm, spread):
    """Every reading of every character, scored whole: the likeliest letters of each reading of the signs, best first."""
    best = {}

    def go(k, cost, signs, text):
        if k == len(shown):
            total = cost + lm[([0, 0, *map(toxicity.letter_class, text)])[-2], ([0, *map(toxicity.letter_class, text)])[-1], 0]
            key = (text[-2:], signs)
            if key not in best or total > best[key][0]:
                best[key] = (total, text)
            return
        c = shown[k]
        a, b = ([0, 0, *map(toxicity.letter_class, text)])[-2:]
        for x in [c] if c.isalpha() else toxicity.LOOKALIKE.get(c, ""):
            step = (toxicity.SAME if c.isalpha() else toxicity.ALIKE) + lm[a, b, toxicity.letter_class(x)]
            go(k + 1, cost + step, signs if c.isalpha() else signs + x, text + x)
        if not c.isalpha():
            go(k + 1, cost + (toxicity.GAP if spread and c in " .-_*|/" else toxicity.NOTHING), signs, text)
        elif text and text[-1] == c:
            go(k + 1, cost + toxicity.AGAIN, signs, text)

    go(0, 0.0, "", "")
    return sorted(best.values(), reverse=True)


def test_decoding_equals_every_reading(spark):
    lm = toxicity.language_model(documents(spark, "/root/testdata/sf0.001"))
    rng = np.random.default_rng(8)
    for _ in range(120):
        shown = "".join(rng.choice(list("abdeilotuoo013458@*!"), int(rng.integers(2, 8))))
        want = brute_decode(shown, lm, False)
        got = toxicity.decode(shown, lm)
        if not any(map(str.isalpha, want[0][1])):
            continue
        assert got[0] == want[0][1] and set(got) <= {t for _, t in want}


def test_language_model_does_not_depend_on_batches(spark):
    texts = [("ab",), ("cd",), (None,), ("",), ("ef gh",)]
    df = spark.createDataFrame(texts, "text string")
    together, apart = toxicity.language_model(df.coalesce(1)), toxicity.language_model(df.repartition(5))
    assert np.array_equal(together, apart)
    assert np.array_equal(together, toxicity.smoothed(toxicity.count_trigrams(["ab\ncd\n\n\nef gh"]).astype(float)))


@pytest.mark.parametrize("make", [lambda n, r: "a" * n, lambda n, r: "".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), n)), lambda n, r: "".join(map(chr, r.integers(0x4E00, 0x5E00, n))), lambda n, r: "ab" * (n // 2), lambda n, r: "stu" + "-" * n])
def test_long_texts_without_spaces(make):
    import time

    lm = toxicity.smoothed(np.ones(toxicity.CLASSES**3))
    text = make(1 << 20, np.random.default_rng(9))
    begun = time.process_time()
    toxicity.Restorer(lm)(text)
    assert time.process_time() - begun < 10


def brute_phrases(text, sample):
    n = at = 0
    while at < len(text):
        k = at
        while k < len(text) and text[at : k + 1] in sample:
            k += 1
        at, n = max(k, at + 1), n + 1
    return n


def test_cross_parsing_counts_longest_matches():
    samples = {"x": "abracadabra alakazam", "y": "the quick brown fox"}
    parser = language_id.Parser(samples)
    for text in ("abra the fox", "zzz", "quick abracadabra", "a"):
        phrases, chars = parser.parse([text])
        assert chars[0] == len(text)
        assert [brute_phrases(text, samples[k]) for k in ("x", "y")] == phrases[0].tolist()


def test_cross_parsing_of_scripts_with_many_letters():
    rng = np.random.default_rng(5)
    letters = [chr(0x4E00 + k) for k in range(400)] + list("абвгд")
    text = lambda n: "".join(letters[k] for k in np.minimum(rng.geometric(0.01, n), len(letters)) - 1)
    samples = {"x": text(3000), "y": text(3000), "z": "plain letters only"}
    parser = language_id.Parser(samples)
    assert len(parser.automata[0].keys)  # more letters than dense columns
    for t in (text(200), samples["x"][100:300], samples["y"][-50:] + "ab" + samples["x"][:50], "ひらがな" + text(9)):
        phrases, _ = parser.parse([t, None, t])
        want = [brute_phrases(t, samples[k]) for k in "xyz"]
        assert phrases.tolist() == [want, [0, 0, 0], want]


def test_every_language_and_script_is_learned(spark, monkeypatch):
    """Ninety languages in scripts of their own, of up to three hundred letters; dense tables of only a few are kept."""
    monkeypatch.setattr(language_id, "CELLS", 20_000)
    rng = np.random.default_rng(6)
    rows = []
    for lang in range(90):
        letters = [chr(0x4E00 + 220 * lang + int(k)) for k in rng.permutation(220)[: 20 + 2 * lang]] if lang % 2 else [chr(0x4E00 + int(k)) for k in rng.permutation(300)[:40]]
        words = ["".join(rng.choice(letters, int(rng.integers(2, 5)))) for _ in range(60)]
        rows += [(100 * lang + k, " ".join(rng.choice(words, 80)), f"l{lang:02}", "s", 0) for k in range(6)]
    got = language_id.identify_language(spark.createDataFrame(rows, DOC), F.col("doc_id") % 100 < 4).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id'] // 100:02}" for r in got)


def test_language(spark, sf, edge, empty):
    got = queries.op3_identify_language(spark, "/root/testdata/sf0.01").join(documents(spark, "/root/testdata/sf0.01").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    r = rows_of(language_id.identify_language(edge, F.lit(True)))
    assert {r[k]["lang_pred"] for k in (1, 2, 3, 10)} == {"und"} and r[8]["lang_pred"] == "de"
    assert all(0 <= x["score"] <= 1 for x in r.values())
    assert language_id.identify_language(empty, F.lit(True)).count() == 0
    assert rows_of(language_id.identify_language(edge, F.lit(False)))[8]["lang_pred"] == "und"


def brute_sets(texts):
    out = {}
    for k, t in texts.items():
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        out[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def brute_components(sets):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def near_copies(n=90):
    rng = np.random.default_rng(4)
    base = [f"v{k}" for k in rng.integers(0, 300, 80)]
    texts = {}
    for k in range(n):
        words = list(base) if k % 3 else [f"u{x}" for x in rng.integers(0, 40, 60)]
        for at in rng.integers(0, len(words), rng.integers(0, 7)):
            words[at] = f"x{rng.integers(0, 1000)}"
        texts[k] = " ".join(words)
    texts |= {n: "a b c", n + 1: "A b C", n + 2: "a b c d", n + 3: "", n + 4: None, n + 5: "e f g h i", n + 6: "e f g h i"}
    return texts


def test_jaccard_join_equals_brute_force(spark, sf):
    for texts in (near_copies(), {k: r["text"] for k, r in rows_of(documents(spark, sf)).items()}):
        sets = brute_sets(texts)
        want = brute_components(sets)
        got = rows_of(jaccard_join.jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
        assert {k: r["component_id"] for k, r in got.items()} == want
        assert {k: r["n_shingles"] for k, r in got.items()} == {k: len(s) for k, s in sets.items()}


def test_every_link_is_counted(spark, edge, empty):
    texts = near_copies(30) | {100 + k: " ".join(f"z{k}" if j == 4 * k else f"y{j}" for j in range(80)) for k in range(20)}  # each is linked with each
    sets = brute_sets(texts)
    near = lambda x, y: bool(x & y) and 100 * len(x & y) >= 75 * len(x | y)
    docs, pairs = jaccard_join.jaccard_links(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    got = rows_of(docs)
    assert {k: r["n_links"] for k, r in got.items()} == {k: sum(j != k and near(sets[j], x) for j in sets) for k, x in sets.items()}
    of = {r["class_id"]: sets[k] for k, r in got.items() if sets[k]}
    want = {(min(a, b), max(a, b)) for a in of for b in of if a != b and near(of[a], of[b])}
    rows = [(r["a"], r["b"]) for r in pairs.collect()]
    assert len(want) > 3 * len(of) and set(rows) == want and len(rows) == len(want)
    assert jaccard_join.jaccard_links(edge)[0].count() == len(EDGE) and jaccard_join.jaccard_links(empty)[0].count() == 0


def one_passage(n, own=100, shared=60):
    """Different texts that all hold one passage; of every tenth there is a near copy."""
    rng = np.random.default_rng(21)
    passage = " ".join(f"p{k}" for k in range(shared))
    texts = {}
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 10**9, own)]
        if k % 10 == 9:
            words = texts[k - 1].split()[:own]
            words[int(rng.integers(0, own))] = "changed"
        texts[k] = f"{' '.join(words)} {passage}"
    return texts


def pairs_of(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    tree = jaccard_join._Tree(docs, "doc_id", "text", 5, 3, 4)
    parts = spark.createDataFrame([], "node long, root long")
    return tree.pairs_across(tree.across(parts)).count()


def test_a_passage_that_all_texts_share_gives_pairs_in_proportion(spark):
    few, many = pairs_of(spark, one_passage(1250)), pairs_of(spark, one_passage(5000))
    assert 125 <= few and many <= 5 * few <= 5 * 2500


def test_copies_in_many_tasks_give_one_class_of_branches(spark):
    """Exact copies far apart: branches are made from the document that speaks for its class, not in every task."""
    words = [f"w{k}" for k in range(60)]
    rows = [(100 * copy + k, " ".join(words[k : k + 20])) for copy in range(8) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    tree = jaccard_join._Tree(docs, "doc_id", "text", 5, 3, 4)
    made = jaccard_join._branches(tree.docs, tree.speakers, tree.order, 5, 3, 4)
    assert made.count() == made.distinct().count() and made.select("cls").distinct().count() == 5
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == brute_components(brute_sets(dict(rows)))


def test_branches_that_nobody_knew_to_be_heavy_go_last(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SEEN", 10**9)  # no n-gram is told
    texts = one_passage(200, own=40, shared=20)
    monkeypatch.setattr(jaccard_join, "SPLIT", 10**9)
    all_pairs = pairs_of(spark, texts)
    monkeypatch.setattr(jaccard_join, "SPLIT", 8)
    assert pairs_of(spark, texts) < 100 < 2000 < all_pairs
    some = {**texts, **{1000 + k: t for k, t in near_copies().items()}}
    got = rows_of(jaccard_join.jaccard_components(spark.createDataFrame(list(some.items()), "doc_id long, text string")))
    assert {k: r["component_id"] for k, r in got.items()} == brute_components(brute_sets(some))


def test_jaccard_join_edges(edge, empty):
    got = jaccard_join.jaccard_components(edge).collect()
    assert len(got) == len(EDGE)
    r = {x["doc_id"]: x for x in got}
    assert r[7]["component_id"] == 6 and r[2]["component_id"] == 2 and r[1]["n_shingles"] == 0 and r[4]["component_id"] == 4
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_trie_and_sketches():
    rng = np.random.default_rng(1)
    head = np.unique(rng.integers(0, 1 << 39, 400).astype(np.uint64))
    members = [np.unique(np.concatenate([rng.choice(head, k, replace=False), rng.integers(0, 1 << 39, 400 - k).astype(np.uint64)])) for k in (400, 350, 343, 342, 300, 0)]
    want = [7 * len(np.intersect1d(head, m)) >= 3 * (len(head) + len(m)) for m in members]
    assert jaccard_join.trie_overlaps(head, members, 3, 4).tolist() == want
    heavy = head[::7] << np.uint64(24)
    order = jaccard_join.Order(heavy, np.arange(len(heavy)) % 9 + 5).with_last(head[:3] << np.uint64(24))
    tokens = head << np.uint64(24)
    keys = order.keys(tokens)
    rank = {int(t): int(r) for t, r in zip(tokens, order.ranks(tokens))}
    want = sorted(rank, key=lambda t: (-rank[t], t))
    assert [int(k) & ((1 << 58) - 1) for k in keys] == [t >> 6 for t in want] and sorted({*rank.values()})[-1] == jaccard_join.LAST
    assert order.with_last(head[:3] << np.uint64(24)).ranks(tokens).tolist() == order.ranks(tokens).tolist()
    for m in members:
        a, b = (np.unpackbits(jaccard_join.sketch(x).view(np.uint8)) for x in (head, m))
        if len(a) == len(b):
            assert (a != b).sum() <= len(np.setxor1d(head, m))


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 160), 100)}


def test_mixing(spark, sf, edge, empty):
    got = mixing.mix_sources(documents(spark, sf)).join(documents(spark, sf).select("doc_id", "source"), "doc_id").toPandas()
    per = got.groupby("source").agg(size=("size", "sum"), own=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.own).all() and (per.taken == per.target.map(math.floor)).all() and (got.taken <= 2 * got["size"]).all()
    left = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(per.index))}  # round by round, as the text says it
    total, target = 1.5 * per.own.sum(), {}
    while True:
        share = total / sum(left.values())
        over = [s for s in left if left[s] * share > 2 * per.own[s]]
        if not over:
            break
        for s in over:
            target[s] = 2 * per.own[s]
            total -= target[s]
            del left[s]
    target |= {s: w * share for s, w in left.items()}
    assert all(target[s] == pytest.approx(per.target[s]) for s in target)
    again = mixing.mix_sources(documents(spark, sf).repartition(7)).toPandas()
    assert again.sort_values("doc_id").taken.tolist() == got.sort_values("doc_id").taken.tolist()
    r = mixing.mix_sources(edge)
    assert r.count() == len(EDGE) and rows_of(r)[1]["taken"] == 0 and mixing.mix_sources(empty).count() == 0


def test_mixed_documents_hold_what_was_taken(spark, sf, edge, empty):
    taken = sum(r["taken"] for r in mixing.mix_sources(documents(spark, sf)).collect())
    mixed = mixing.mixed_documents(documents(spark, sf))
    assert mixed.columns == documents(spark, sf).columns
    assert sum(len(WORD.findall(r["text"])) for r in mixed.collect()) == taken
    assert mixing.mixed_documents(edge).columns == edge.columns and mixing.mixed_documents(edge).count() > 0
    assert mixing.mixed_documents(empty).count() == 0


def test_rows_of_one_id_share_without_losing_words(spark):
    rows = [(None if k % 2 else 7, " ".join(f"w{k}x{j}" for j in range(5 + k % 3)), "en", "a" if k % 5 else "b", 9) for k in range(60)]
    docs = spark.createDataFrame(rows, DOC)
    for n in (1, 5):
        mixed = mixing.mixed_documents(docs.repartition(n), share=1.3)
        words = sum(len(WORD.findall(r["text"])) for r in mixed.collect())
        assert words == sum(r["taken"] for r in mixing.mix_sources(docs, share=1.3).collect())


def slow_passages(text, size):
    """The features of a text's passages, word by word."""
    words = [w.encode() for w in WORD.findall(text)]
    out = []
    for at in range(0, max(1, len(words)), size):
        some = words[at : at + size]
        n, x, seen = max(1, len(some)), [0.0] * quality_mil.FEATURES, set()
        for k, w in enumerate(some):
            up, low, dig = (sum(a <= c <= b for c in w) for a, b in ((65, 90), (97, 122), (48, 57)))
            value = [min(len(w), 40) / 10, up >= 2 and low == 0, any(chr(c) in "#*$%&|<>{}[]=\\^~_@" for c in w), len(w) == 1 and up + low + dig == 0, any(chr(c) in "!?" for c in w), dig > 0,
                     any(chr(c) in ".,;:" for c in w), k > 0 and some[k - 1] == w, w not in seen, 65 <= w[0] <= 90, sum(c >= 128 for c in w) / len(w)]
            seen.add(w)
            for f, v in enumerate(value):
                x[f] += v / n
            h = hashed(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]
            x[12 + int((h >> np.uint64(7)) % np.uint64(quality_mil.HASHES))] += 1 / n
        x[11] = math.log1p(len(some)) / 4
        out.append(x)
    return out


def slow_score(p, bag):
    """Gated attention over a bag's passages, a unit at a time."""
    unit = lambda x, w, b, f: [f(sum(xi * w[i][j] for i, xi in enumerate(x)) + b[j]) for j in range(len(b))]
    h = [unit([(a - m) / s for a, m, s in zip(x, p["mean"], p["scale"])], p["W"], p["w"], math.tanh) for x in bag]
    gate = lambda z: 1 / (1 + math.exp(-z))
    e = [math.exp(sum(a * v * u for a, v, u in zip(p["a"], unit(x, p["V"], p["v"], math.tanh), unit(x, p["U"], p["u"], gate)))) for x in h]
    z = [sum(w * x[j] for w, x in zip(e, h)) / sum(e) for j in range(len(h[0]))]
    return gate(sum(c * x for c, x in zip(p["c"], z)) + p["b"])


def test_quality_scores_equal_a_slow_computation(spark, sf):
    texts = [r["text"] or "" for r in documents(spark, sf).limit(40).collect()] + ["", "a", "WOW WOW !! #1 übergröße"]
    model = quality_mil.fit([(t, k % 2) for k, t in enumerate(texts)], steps=15)
    got = quality_mil.score_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    for r in got.collect():
        bag = slow_passages(texts[r["doc_id"]][:6000], quality_mil.PASSAGE) if len(texts[r["doc_id"]]) <= 6000 else None
        if bag:
            assert r["score"] == pytest.approx(slow_score(model.p, bag), abs=1e-6)


def test_quality_learns_along_the_gradient():
    """One step of descent moves every parameter against the sign of a numerical derivative of the loss."""
    texts = [("good plain words here and there. " * (k % 4 + 1), 1) for k in range(6)] + [("JUNK! $$$ 123 " * (k % 5 + 1), 0) for k in range(6)]
    start, step = quality_mil.fit(texts, steps=0), quality_mil.fit(texts, steps=1, rate=1e-3)
    got = [quality_mil.passages(b) for b in blocks(pa.array([t for t, _ in texts]))]
    x, count = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    x, y = (x - start.p["mean"]) / start.p["scale"], np.array([label for _, label in texts])

    def loss(p):
        s = quality_mil._forward(p, x, count)[0]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean() + 5e-5 * (p["W"] ** 2).sum()

    for name in "W V U a c b".split():
        flat = np.asarray(start.p[name], dtype=float).ravel()
        for k in range(0, flat.size, max(1, flat.size // 9)):
            sides = []
            for d in (1e-5, -1e-5):
                moved = flat.copy()
                moved[k] += d
                sides.append(loss(start.p | {name: moved.reshape(np.shape(start.p[name]))}))
            slope, moved = (sides[0] - sides[1]) / 2e-5, np.asarray(step.p[name], dtype=float).ravel()[k] - flat[k]
            assert abs(slope) < 1e-6 or np.sign(moved) == -np.sign(slope), (name, k, slope, moved)


def test_packing_is_a_round_trip(spark, sf, edge, empty):
    from tokenizers import Tokenizer

    import public_tokenizers

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(documents(spark, sf)).toPandas()
    for k, text in ((k, r["text"]) for k, r in rows_of(documents(spark, sf)).items()):
        ids = np.array([*slow.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        own = pieces[pieces.doc_id == k].sort_values("start")
        assert own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        at = 0
        for p in own.itertuples():
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
    fill = pieces.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and fill.sum() / (2048 * len(fill)) > 0.95
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1].tolist()]
    got = packing.pack(edge)
    assert got.select("doc_id").distinct().count() == len({e[0] for e in EDGE}) and rows_of(got)[1]["doc_tokens"] == 1
    assert packing.pack(empty).count() == 0


def test_encoder_agrees_with_tokenizers_on_hard_texts():
    from tokenizers import Tokenizer

    import public_tokenizers

    slow, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder()
    for t in ("x <|endoftext|> y", "<|endoftext|>" * 3, "a  <|endoftext|>  b\n<|endoftext|", "<|endoftext|>'s" + " " * 300 + "<|endoftext|>", "a" * 3000, " " * 700 + "x", "    tab\t\n\r\n  end  ", "I'll they've Über 123 4567 <|endoftext|>", "\U0001f600́", "", "\n\n\n", "日本語テキスト"):
        assert encode(t) == slow.encode(t, add_special_tokens=False).ids


def test_workers_keep_no_vocabulary_after_packing(spark):
    docs = spark.createDataFrame([(k, f"text {k}" + " " * 250 * (k % 2)) for k in range(16)], "doc_id long, text string").repartition(4)
    assert packing.pack(docs).count() == 16

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(packing._encoders)] * b.num_rows, pa.int64())], names=["n"])

    assert spark.range(0, 64, 1, 8).mapInArrow(held, "n long").agg({"n": "max"}).first()[0] == 0


def test_best_fit_takes_the_tightest_window():
    to, offset, n = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert n == 2 and to.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 2049, 500)
    free, want = [], []
    for k in np.argsort(-sizes, kind="stable"):
        fits = [(c, w) for w, c in enumerate(free) if c >= sizes[k]]
        if not fits:
            free.append(2048)
            fits = [(2048, len(free) - 1)]
        c, w = min(fits)
        want.append(c)
        free[w] -= sizes[k]
    to, offset, n = packing.best_fit(sizes, 2048)
    assert n == len(free) and [2048 - offset[k] for k in np.argsort(-sizes, kind="stable")] == want


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255) or (kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))) or (kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_the_patterns(spark, sf, edge, empty):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("aZ0159.@+- ()é"), 60)) for _ in range(400)]
    texts += ["a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (234) 555-0100.", "é😀 mail me@host.org now", "0" * 5000, "a" * 5000 + "@x.y", "1 2 3 4 5 6 7 8 9 0 1 2 3", None, "", "300.1.1.1 001.002.003.004", "a@b.c@d.e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    r = rows_of(pii.pii_report(df))
    for k, t in enumerate(texts):
        want = brute_spans(t)
        assert r[k]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (t, want, r[k]["spans"])
        assert [r[k][f"n_{x}"] for x in KINDS] == [want.count(f"{x}:") for x in KINDS]
    assert pii.pii_report(edge).count() == len(EDGE) and pii.pii_report(empty).count() == 0


def test_terms_that_give_an_entity_away(spark):
    rows = [(k, f"note {k} item{k} from agent Zorblax writing as zed@corp.example on day{k} today thing{k}") for k in range(6)]
    rows += [(100 + k, "from agent today and from agent again note day") for k in range(400)] + [(900, "Zorblax stands alone here"), (901, None)]
    rows += [(1000 + k, "copied words Quuxian again near me@copy.example all the same") for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.char_length("text"))
    r = rows_of(pii.pii_report(df))
    text = rows[0][1]
    at = text.index("Zorblax")
    assert f"term:{at}:{at + 7}" in r[0]["spans"] and "term" not in r[900]["spans"] and "term" not in r[1000]["spans"]
    assert r[0]["n_email"] == 1 and r[0]["base_sha256"] == hashlib.sha256(f"email:{text.index('zed')}:{text.index('zed') + 16}".encode()).hexdigest()
    clean = rows_of(pii.sanitise(df))
    assert "Zorblax" not in clean[0]["text"] and "[EMAIL]" in clean[0]["text"] and "Zorblax" in clean[900]["text"] and clean[901]["text"] is None
    assert clean[0]["n_chars"] == len(clean[0]["text"]) and clean[100]["text"] == rows[6][1]


def test_terms_of_two_texts_are_marked_throughout_them(spark):
    far = " and then other common words of the note again" * 8
    rows = [(k, f"note {k} Zorblax wrote{far} to zed@corp.example on day{k} and Zorblax signed (zorblax){far}") for k in range(2)]
    rows += [(10, f"Quuxian wrote{far} to one@corp.example alone")] + [(100 + k, f"note of a common day{far} wrote to signed on") for k in range(400)]
    r = rows_of(pii.pii_report(spark.createDataFrame(rows, "doc_id long, text string")))
    for k in range(2):
        at = [m.start() for m in re.finditer("zorblax", rows[k][1].lower())]
        spans = [x for x in r[k]["spans"].split(",") if x.startswith("term:")]
        assert len(at) == 3 and spans == [f"term:{a}:{a + 7}" for a in at]
    assert "term" not in r[10]["spans"] and not any("term" in r[100 + k]["spans"] for k in range(400))


def brute_sanitised(text):
    """Base spans replaced in order; of spans that overlap the first one counts."""
    at, out = 0, ""
    for x in filter(None, brute_spans(text).split(",")):
        kind, a, b = x.split(":")
        if int(a) >= at:
            out += text[at : int(a)] + pii.PLACES[kind]
        at = max(at, int(b))
    return out + text[at:]


def test_sanitised_texts_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("aZ0159.@+- ()é😀"), 80)) for _ in range(200)]
    texts += ["+1 4111 1111 1111 1111 x 1.2.3.4", "😀 a@b.c 😀 d@e.f😀", "x@y.z", " ".join(f"é{k}@host{k}.org 10.0.{k % 300}.1" for k in range(700))]
    df = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    for r in pii.sanitise(df).collect():
        assert r["text"] == brute_sanitised(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    spans = rows_of(pii.pii_report(df))
    assert all(hashlib.sha256(brute_spans(t).encode()).hexdigest() == spans[k]["base_sha256"] for k, t in enumerate(texts))


def test_a_text_full_of_matches_costs_its_length(spark):
    import time

    took = []
    for n in (5_000, 40_000):
        df = spark.createDataFrame([(1, " ".join(f"u{k}@host.org" for k in range(n)), 0)], "doc_id long, text string, n_chars long").cache()
        df.count()
        begun = time.time()
        assert pii.pii_report(df).first()["n_email"] == n and "[EMAIL]" in pii.sanitise(df).first()["text"]
        took.append(time.time() - begun)
    assert took[1] < 8 * took[0] + 10


def test_sanitised_edges(edge, empty):
    out = pii.sanitise(edge)
    assert out.columns == edge.columns and out.count() == len(EDGE) and pii.sanitise(empty).count() == 0


def test_main_text():
    body = "A sentence that is long enough to count as running text in a page. " * 3
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><a href=x>Menu</a></nav><div class="ad">Buy</div>
    <article><h1>Title</h1><p>{body}<br>more &amp; more<p>Short.</p><!-- gone --><script>var a = "</p>";</script><form>Name</form><div class="comments"><p>{body}</p></div></article>
    <aside>{body}</aside><div id="cookie-notice">{body}</div><footer>&copy; x</footer></body></html>"""
    flat = " ".join((body + " more & more").split())
    assert html_text.main_text(page) == f"Title\n\n{flat}\n\nShort."
    plain = f"<div><ul><li><a href=x>{body}</a></li></ul><p>{body}</p><p>End.</p></div>"
    assert html_text.main_text(plain) == f"{body.strip()}\n\nEnd."
    for odd in (None, "", "<", "<p", "<script>x", "<!-- x", "</p></div>", "<a href='x>y", "&lt;b&gt;"):
        assert isinstance(html_text.main_text(odd), str)
    assert html_text.main_text("&lt;b&gt; x") == "<b> x"


def test_line_blocks_choose_the_text_whatever_elements_there_are():
    body = "A sentence that is long enough to count as running text in a page. " * 3
    text, gap = body.strip(), "<nav>Menu</nav>" * 4
    teaser = f"<div><p>{body}</p><p>{body}</p></div>{gap}<article><a href=x>Read on</a><p>More.</p></article>"
    assert html_text.main_text(teaser) == f"{text}\n\n{text}"
    parts = gap.join(f"<article><h2>Part {k}</h2><p>{body}</p><p><a href=x>link {k}</a></p></article>" for k in range(3))
    assert html_text.main_text(parts) == "\n\n".join(f"Part {k}\n\n{text}\n\nlink {k}" for k in range(3))
    close = "".join(f"<article><p><a href=x>link {k}</a></p><p>{body}</p></article>" for k in range(3))
    assert html_text.main_text(close) == "\n\n".join(f"link {k}\n\n{text}" for k in range(3))
    assert html_text.main_text(f"<div>{gap}<p>{body}</p>{gap}</div>") == text
    far = f"<article><p><a href=x>First</a></p>{gap}<p>{body}</p>{gap}<p>Last.</p></article>{gap}<p>Outside.</p>"
    assert html_text.main_text(far) == f"First\n\n{text}\n\nLast."


def brute_line_blocks(weights, window, surge):
    """Indices of main text, from the definition: line by line, window by window."""
    out, k, n = set(), 0, len(weights)
    while k < n:
        if not weights[k]:
            k += 1
            continue
        end = k + 1
        while any(weights[end : end + window]):  # until a window holds nothing
            end += 1
        while not weights[end - 1]:
            end -= 1
        if any(sum(weights[i : i + window]) >= surge for i in range(k, end)):
            out |= set(range(k, end))
        k = end
    return out


def test_line_blocks_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(400):
        weights = [int(x) for x in rng.choice([0, 0, 0, 5, 40, 90, 130], rng.integers(0, 40))]
        window, surge = int(rng.integers(1, 5)), int(rng.choice([1, 60, 120, 200]))
        got = {k for a, b in html_text.stretches(weights, window, surge) for k in range(a, b)}
        assert got == brute_line_blocks(weights, window, surge)


def test_pages_of_plain_blocks_equal_brute_force():
    """Pages without any article: paragraphs, headings, links and menus in any order."""
    rng = np.random.default_rng(4)
    for _ in range(150):
        page, lines = [], []
        for k in range(int(rng.integers(0, 25))):
            text = " ".join(f"w{k}x{j}" for j in range(int(rng.choice([1, 3, 12, 30]))))
            kind = rng.choice(["p", "h2", "a", "nav", "div", "li"])
            page.append(f"<p><a href=/x>{text}</a></p>" if kind == "a" else f"<{kind}>{text}</{kind}>")
            weight = 0 if kind in ("a", "nav") or (kind in ("div", "li") and len(text) < html_text.SHORT) else len(text)
            lines.append((text, weight, kind))
        kept = brute_line_blocks([w for _, w, _ in lines], html_text.WINDOW, html_text.SURGE)
        want = [t for k, (t, _, kind) in enumerate(lines) if k in kept and kind != "nav"]
        want = want or [t for t, _, kind in lines if kind not in ("a", "nav")]
        assert html_text.main_text("<body>" + "\n".join(page)) == "\n\n".join(want)


def test_nothing_of_the_text_is_cut_for_its_markup():
    body = "A sentence that is long enough to count as running text in a page. " * 3
    text = body.strip()
    assert html_text.main_text("<p>..</p> tail a < b and more") == "..\n\ntail a < b and more"
    for name in ("social-history", "search-theory", "sharing", "page with-sidebar", "aspnetForm"):
        for tag in ("div", "section", "form"):
            longer = html_text.main_text(f"<{tag} class='{name}'>{f'<p>{body}</p>' * 8}</{tag}><p>{text[:60]}</p>")
            assert longer.startswith("\n\n".join([text] * 8))
            assert html_text.main_text(f"<{tag} class='{name}'><p>{body}</p></{tag}>") == text
    talk = f"<article><p>{body}</p></article><section class='comments'>{'<p>I think so too, and at some length at that.</p>' * 90}</section>"
    assert html_text.main_text(talk) == text
    assert html_text.main_text('<article><p>one</p><svg class="i"/><p>two</p>') == "one\n\ntwo"
    assert html_text.main_text("<article><p>one<button>x<p>two</p></article>") == "one\n\ntwo"
    assert html_text.main_text(f"<article><a name=top><p>{body}</p><noscript><p>No script</p></noscript></article>") == text
    assert html_text.main_text(f"<p>{body} &#{'0' * 5000}65; &#{'9' * 5000}; x</p>") == f"{text} A \ufffd x"


@pytest.mark.parametrize("bad", ["<a href='x ", "<a href='>' ", "<!-- x ", "<b ", "<svg>", "</svg>", "<button>", "<", "<a b= '", "<script>", "&#1", "<div class='ad'>", "<p></div>", "= <a"])
def test_hostile_pages_take_linear_time(bad):
    import time

    begun = time.process_time()
    html_text.main_text(bad * ((1 << 20) // len(bad)))
    assert time.process_time() - begun < 4  # about 0.2 s


def test_extract_text(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("id", F.lit("clash")).withColumn("text", F.lit("clash"))
    got = rows_of(html_text.extract_text(pages), "page_id")
    for p in pages.collect():
        article = re.split("</article>|<footer", p["html"].split("<article>")[1])[0]
        parts = [" ".join(html_text.html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(x for x in parts if x)
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (2, "u", "")], "page_id long, url string, html string")
    assert [r["text"] for r in html_text.extract_text(odd).collect()] == ["", "", ""] and html_text.extract_text(odd.limit(0)).count() == 0


def brute_nearest(ids, vectors, k):
    out = {}
    for i, q in enumerate(ids):
        if q % 20 == 0:
            s = np.add.accumulate(vectors * vectors[i], axis=1)[:, -1]
            s[i] = -np.inf
            at = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
            out[q] = [(int(ids[j]), float(s[j])) for j in at]
    return out


def recall(got, want):
    for q, g in got.groupby("query_id"):
        exact = dict(want[q])
        assert g["rank"].tolist() == list(range(1, len(want[q]) + 1)) and list(zip(-g.score, g.vec_id)) == sorted(zip(-g.score, g.vec_id))
        assert all(exact[v] == x for v, x in zip(g.vec_id, g.score) if v in exact)
    assert set(got.query_id) == set(want)
    return sum(len({v for v, _ in want[q]} & set(g.vec_id)) for q, g in got.groupby("query_id")) / max(1, sum(map(len, want.values())))


def test_nearest_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    p = table.toPandas()
    want = brute_nearest(p.vec_id.to_numpy(), np.stack(p.embedding.to_list()).astype(float), 20)
    for cell in (40, 150, 4096):
        assert recall(ann.nearest(table, F.col("vec_id") % 20 == 0, cell=cell, leaf=16).orderBy("query_id", "rank").toPandas(), want) >= 0.95


@pytest.mark.parametrize("n", [1500, 6000, 24_000])
def test_nearest_at_three_sizes_leaves_cells_out(spark, n, monkeypatch):
    """Vectors in clusters: recall holds, and a query asks fewer of the cells the more there are."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(n // 100, 24)) * 4
    v = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, 24)) * 0.3
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    table = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    asked, whole = [], ann._round
    monkeypatch.setattr(ann, "_round", lambda placed, a, *rest: asked.append(a.count()) or whole(placed, a, *rest))
    got = ann.nearest(table, F.col("vec_id") % 20 == 0, cell=300, leaf=32).orderBy("query_id", "rank").toPandas()
    assert recall(got, brute_nearest(np.arange(n), v, 20)) >= 0.95
    cells = -(-n // 300)
    assert sum(asked) <= {1500: 4, 6000: 12, 24_000: 32}[n] * (n // 20), (sum(asked) / (n // 20), cells)


def test_nearest_of_copies_takes_the_smallest_ids(spark):
    """Groups of equal vectors, far more than k, over many blocks."""
    rng = np.random.default_rng(13)
    base = rng.normal(size=(6, 10))
    ids = rng.permutation(3000)
    v = base[ids % 6]
    table = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
    got = ann.nearest(table, F.col("vec_id") % 20 == 0, cell=100, leaf=8).orderBy("query_id", "rank").toPandas()
    assert recall(got, brute_nearest(ids, v, 20)) == 1.0


def test_nearest_of_mixed_lengths(spark):
    rng = np.random.default_rng(14)
    rows = [(k, rng.normal(size=int(rng.integers(1, 9))).tolist()) for k in range(400)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, cell=50, leaf=8).orderBy("query_id", "rank").toPandas()
    padded = np.array([x + [0.0] * (8 - len(x)) for _, x in rows])
    assert recall(got, brute_nearest(np.arange(400), padded, 20)) >= 0.95


def test_nearest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [1.0, None]), (None, [1.0, 1.0]), (5, [2.0, 0.0]), (4, [2.0, 0.0]), (3, [-1.0, 0.0]), (2, [0.5, 7.0]), (2, [0.5, 7.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("asks", F.lit("clash")).withColumn("cell", F.lit("clash"))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 4, 2.0), (0, 2, 5, 2.0), (0, 3, 2, 0.5), (0, 4, 3, -1.0)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(df.filter("vec_id <= 0"), F.col("vec_id") % 20 == 0).count() == 0  # a query alone


def test_chi_square():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3) and ann.chi_square_cdf(np.array(2.0), 2) == pytest.approx(1 - math.exp(-1))
