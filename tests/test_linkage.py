"""Decisions, evaluation, contracts, sources and whole runs on small tables."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import contracts, decisions, evaluation, fuzzy, model, ordinal, ranked, reports, truth
from linkloom.plans import catalogue, linkage
from linkloom.sources import tables

PAIRS = "source1_id string, target_source string, target_id string, retrieval_score double"


@pytest.fixture(scope="module")
def small(spark):
    return {k: df.persist() for k, df in tables.synthetic_records(spark, 60).items()}


def test_packed_lists(spark):
    rows = [("oak", "S3", "t7", 0.25), ("oak", "S2", "t9", 0.25), ("oak", "S2", "t4", 0.7500000012), ("oak", "S2", "t5", 0.7500000049), ("elm", "S3", "t1", 0.5)]
    queries = spark.createDataFrame([("elm",), ("fir",), ("oak",)], "entity_id string")
    got = {r[0]: r[1] for r in decisions.packed_lists(queries, spark.createDataFrame(rows, PAIRS), "retrieval_score", "ids").collect()}
    assert got == {"oak": "t4,t5,t9,t7", "elm": "t1", "fir": ""}  # scores that agree in 8 digits are equal


def test_top_candidates(spark):
    rows = [("oak", "S2", f"t{k}", float(k % 5)) for k in range(10)] + [("oak", "S2", "t4", -1.0), ("oak", "S3", "u1", 0.0)]
    got = decisions.top_candidates(spark.createDataFrame(rows, PAIRS), 3, "retrieval_score").collect()
    assert {r["target_id"] for r in got} == {"t4", "t9", "t3", "u1"}
    with pytest.raises(ValueError):
        decisions.top_candidates(spark.createDataFrame(rows, PAIRS), -2, "retrieval_score")


SCORED = "source1_id string, target_id string, target_source string, candidate_rank int, probability double, label int"


def test_f_half_and_operating_point(spark):
    q = spark.createDataFrame([(f"q{k}",) for k in range(4)], "entity_id string")
    edges = spark.createDataFrame([("q1", "x"), ("q1", "y"), ("q2", "z")], "source1_id string, target_id string")
    scored = spark.createDataFrame([("q1", "x", "S2", 1, 0.9, 1), ("q1", "w", "S2", 2, 0.4, 0), ("q3", "z", "S3", 1, 0.3, 0)], SCORED)
    swept = {(r["cap_per_source"], r["threshold"]): r for r in evaluation.sweep(q, scored, edges, caps=[1, 2], thresholds=[0.35, 0.2]).collect()}
    # q0 and q2 are always 1 and 0; q1 has one of two links (1.25 / 1.5), with the wrong one too 1.25 / 2.5; q3 is wrong at 0.2.
    assert swept[1, 0.35]["macro_f0_5"] == pytest.approx((1 + 1.25 / 1.5 + 1) / 4, abs=1e-8)
    assert swept[2, 0.2]["macro_f0_5"] == pytest.approx((1 + 0.5) / 4, abs=1e-8)
    assert {r["candidate_hits"] for r in swept.values()} == {1} and swept[2, 0.2]["candidate_recall"] == pytest.approx(1 / 3)
    rows = [(2, 0.5, 0.70), (3, 0.992, 0.7995), (5, 0.995, 0.801), (9, 0.999, 0.8005)]
    caps = spark.createDataFrame(rows, "cap_per_source int, candidate_recall double, macro_f0_5 double")
    assert evaluation.operating_point(caps).first()["cap_per_source"] == 3  # enough recall, near the best
    assert evaluation.operating_point(caps, recall_gate=0.9995).first()["cap_per_source"] == 5  # none has: the best
    assert evaluation.operating_point(caps.limit(0)).isEmpty()


def test_target_audit(spark):
    refs = spark.createDataFrame([("a", "US", 0), ("b", "US", 1), ("c", "Peru", 1), ("d", "India", 4)], "entity_id string, country string, fold int")
    edges = spark.createDataFrame([("a", "t1"), ("b", "t2"), ("d", "t4")], "source1_id string, target_id string")
    rows = [("a", "t1", 1, 0.8, 1), ("b", "t2", 2, 0.9, 1), ("c", "t2", 1, 0.6, 0), ("d", "t4", 1, 0.55, 1), ("a", "t9", 1, 0.58, 0)]
    scored = spark.createDataFrame(rows, "source1_id string, target_id string, candidate_rank int, probability double, label int")
    point, countries = evaluation.target_audit(refs, scored, edges, 4)
    r = point.first()
    # With two candidates a target t2 finds its query; from 0.6 on the wrong t9 is out; the highest such threshold is 0.8, at which d's link is lost.
    assert (r["cap_per_target"], r["threshold"], r["macro_f0_5"], r["audit_macro_f0_5"]) == (2, 0.8, 1.0, 0.0)
    assert (r["audit_source1_entities"], r["truth_entities"], r["matched_pairs"], r["predicted_pairs"], r["candidate_pairs"], r["candidate_recall"]) == (1, 3, 2, 2, 5, 1.0)
    assert {x["country"]: x["macro_f0_5"] for x in countries.collect()} == {"US": 1.0, "Other": 1.0}
    recall = {x["cap"]: x["candidate_recall"] for x in evaluation.target_recall(scored, edges).collect()}
    assert recall[1] == pytest.approx(2 / 3) and recall[2] == 1.0


def test_target_cells_count_before_they_are_dealt_by_threshold(spark):
    import random
    from fractions import Fraction

    r, caps, thresholds = random.Random(4), [1, 2, 4], [0.7, 0.2, 0.5]
    refs = [(f"q{k}", "xy"[k % 2]) for k in range(9)]
    rows = [(f"q{q}", f"t{t}", k + 1, r.choice([0.1, 0.2, 0.5, 0.6, 0.9]), int(r.random() < 0.4)) for t in range(40) for k, q in enumerate(r.sample(range(9), r.randint(1, 5)))]
    edges = sorted({(q, t) for q, t, _, _, label in rows if label} | {("q1", "t99")})
    scored = spark.createDataFrame(rows, "source1_id string, target_id string, candidate_rank int, probability double, label int")
    cells = evaluation.target_cells(spark.createDataFrame(refs, "entity_id string, country string"), scored, spark.createDataFrame(edges, "source1_id string, target_id string"), ["country"], caps, thresholds)
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join Cross") + plan.count("Join Inner, true") + plan.count("Join Inner\n") <= 1 and "candidate_rank <= cap" not in plan  # no pair meets each setting
    got = {(x["cap"], x["threshold"], x["country"]): (x["n"], round(x["f"], 9), x["tp"], x["predicted"], x["with_truth"]) for x in cells.collect()}
    want = {}
    for cap in caps:
        best = {}
        for q, t, rank, p, label in rows:
            if rank <= cap:
                best[t] = min(best.get(t, (9,)), (-p, rank, q, label))
        for limit in thresholds:
            for country in "xy":
                f, tp, predicted, some, own = Fraction(0), 0, 0, 0, [q for q, c in refs if c == country]
                for q in own:
                    won = [b[3] for b in best.values() if b[2] == q and -b[0] >= limit]
                    known = sum(e[0] == q for e in edges)
                    f += 1 if not won and not known else Fraction(5 * sum(won), 4 * len(won) + known) if won and known else 0
                    tp, predicted, some = tp + sum(won), predicted + len(won), some + (known > 0)
                want[cap, limit, country] = (len(own), round(float(f), 9), tp, predicted, some)
    assert got == want


def brute_rule(f):
    """The rules as a table of conditions, on one pair's features."""
    big = lambda c: max(f[c], f["roman_" + c])
    n, w, en = big("name_edit_similarity"), big("name_token_jaccard"), big("exact_name")
    a, p, ea = big("address_edit_similarity"), big("address_token_jaccard"), big("exact_address")
    near = ea or f["postal_equal"] or f["house_number_equal"] or f["number_jaccard"] >= 0.5
    return bool((en and (a >= 0.25 or p >= 0.3 or near)) or (n >= 0.94 and w >= 0.55 and (a >= 0.45 or p >= 0.35 or near)) or (n >= 0.87 and w >= 0.5 and (a >= 0.7 or p >= 0.55)) or (n >= 0.75 and w >= 0.35 and (a >= 0.93 or p >= 0.78 or ea)))


def test_rules_equal_their_conditions(spark):
    import random

    r = random.Random(2)
    names = [x for c in ("name_edit_similarity", "name_token_jaccard", "exact_name", "address_edit_similarity", "address_token_jaccard", "exact_address") for x in (c, f"roman_{c}")]
    names += ["postal_equal", "house_number_equal", "number_jaccard", "candidate_rank_reciprocal"]
    rows = [tuple(float(r.random() < 0.2) if "exact" in c or "equal" in c else r.choice([0.1, 0.3, 0.36, 0.5, 0.56, 0.72, 0.8, 0.9, 0.95]) for c in names) for _ in range(600)]
    got = {x["k"] for x in decisions.rule_matches(spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], ", ".join(["k int", *[f"{c} double" for c in names]]))).collect()}
    want = {k for k, x in enumerate(rows) if brute_rule(dict(zip(names, x, strict=True)))}
    assert got == want and 0 < len(want) < 600


def test_threshold_ties(spark):
    q = spark.createDataFrame([("a",)], "entity_id string")
    edges = spark.createDataFrame([("a", "x")], "source1_id string, target_id string")
    scored = spark.createDataFrame([("a", "x", "S2", 1, 0.7, 1)], "source1_id string, target_id string, target_source string, candidate_rank int, probability double, label int")
    best = evaluation.best_per_cap(evaluation.sweep(q, scored, edges, caps=[4])).first()
    assert best["threshold"] == 0.05  # the lowest
    at, score = evaluation.calibrated(q, scored, edges, 4, 0.5)
    assert at["S2"] == 0.7 and at["S3"] == 1.01 and score == 1.0  # the highest
    swept = evaluation.target_sweep(q, scored, edges, caps=[1, 2])
    assert evaluation.target_operating_point(swept).first()["threshold"] == 0.7


def test_contracts(spark):
    q = spark.createDataFrame([("q1",), ("q2",)], "entity_id string")
    make = lambda *rows: spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_ids string")
    assert contracts.validate_lists(make(("q1", "S2-1,S3-1"), ("q2", "")), q, 1) == (2, 1)
    for bad in (make(("q1", "")), make(("q1", "S2-1,S2-1"), ("q2", "")), make(("q1", "S2-1,S2-2"), ("q2", "")), make(("q1", ""), ("q1", "")), make(("q1", "S9-1"), ("q2", "")), make(("q1", "S2-1,"), ("q2", ""))):
        with pytest.raises(contracts.ContractError):
            contracts.validate_lists(bad, q, 1)
    with pytest.raises(contracts.ContractError):
        contracts.assert_no_rows(q, "rows")


def test_truth(spark):
    packed = spark.createDataFrame([("a", "x, y,"), ("b", None), (" c ", "x,x")], "source1_entity_id string, matched_entity_ids string")
    edges = truth.truth_edges(packed)
    assert sorted(map(tuple, edges.collect())) == [("a", "x"), ("a", "y"), ("c", "x")]
    assert {r["links"]: r["queries"] for r in truth.group_sizes(packed).collect()} == {2: 2, 0: 1}
    assert tuple(truth.truth_violations(edges, spark.createDataFrame([("a",)], "entity_id string")).first()) == (1, 1)


def brute_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old, row = row, [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1]


def test_fuzzy_ratios():
    import random

    r = random.Random(4)
    for _ in range(300):
        a, b = ("".join(r.choices("abc d", k=r.randint(0, 14))) for _ in range(2))
        assert fuzzy.common_subsequence(a, b) == brute_subsequence(a, b)
        assert fuzzy.ratio(a, b) == (2 * brute_subsequence(a, b) / (len(a) + len(b)) if a and b else 0)
        short, long = sorted((a, b), key=len)
        parts = {long[max(0, k) : k + len(short)] for k in range(1 - len(short), len(long))} if short else set()
        if len(a) == len(b):
            both = [fuzzy.ratio(b, a[max(0, k) : k + len(a)]) for k in range(1 - len(a), len(a))]
        else:
            both = []
        assert fuzzy.partial(a, b) == pytest.approx(max([0.0, *[fuzzy.ratio(short, p) for p in parts], *both]))
    assert fuzzy.token_sort("quay south 9", "9 south quay") == 1.0 and fuzzy.token_set("blue heron", "heron blue cafe") == 1.0
    assert fuzzy.token_set("p q", "r s") == pytest.approx(1 / 3) and fuzzy.partial("heron", "the heron inn") == 1.0


def test_ratios_of_many_pairs_side_by_side(monkeypatch):
    """A batch gives what pairs alone give, exactly, and compares no pair alone."""
    import random

    r = random.Random(7)
    kinds = [("abc d", 14, 200), ("ab", 9, 200), ("aé語 \U0001f600", 20, 100), ("ab c", 300, 10), ("", 0, 3)]
    a, b = ([k for letters, most, n in kinds for k in ("".join(r.choices(letters, k=r.randint(0, most))) if most else "" for _ in range(n))] for _ in range(2))
    want = {n: [f(x, y) for x, y in zip(a, b, strict=True)] for n, f in fuzzy._RATIOS.items()}

    def alone(*_):
        raise AssertionError("a pair alone")

    for name in ("common_subsequence", "ratio", "partial", "_best_part"):
        monkeypatch.setattr(fuzzy, name, alone)
    got = fuzzy.similarities(a, b, list(want))
    assert {n: got[n].tolist() for n in want} == want
    assert all(len(x) == 0 for x in fuzzy.similarities([], [], list(want)).values())


PLACES = "entity_id string, business_name string, business_address string, country string"


def _registers(spark):
    refs = [("S1-a", "Kestrel Foundry Inc", "88 Tanner Lane Duluth MN", "US"), ("S1-b", "Marlow Ferries", "3 Dock Road", "US"), ("S1-c", "Boulangerie Fête Dorée", "5 quai du Port Lorient", "France")]
    targets = [("S2-a", "Kestrel Foundries", "88 Tanner Ln Duluth MN", "US"), ("S2-c", "Boulangerie Fete Doree SAS", "5 quai du port Lorient", "France"), ("S3-e", "", "", "US"), ("S3-f", "Kestrel", "", "Nowhere")]
    return spark.createDataFrame(refs, PLACES), spark.createDataFrame(targets, PLACES)


def test_ranked_retrieval(spark):
    refs, targets = _registers(spark)
    for scripts in (False, True):
        found = ranked.search(ranked.record_fields(targets, scripts), ranked.index(ranked.record_fields(refs, scripts), list(ranked.VIEWS["joint"])))
        first = {r["target_id"]: r["rid"] for r in found.filter("view = 'joint' and view_rank = 1").collect()}
        assert first == {"S2-a": "S1-a", "S2-c": "S1-c"}
    fused = ranked.fuse(found)
    assert fused.filter("target_id = 'S2-a' and candidate_rank = 1").first()["rid"] == "S1-a"
    wide = linkage.wide_pairs(fused, refs, targets.filter("entity_id = 'S2-a'"), targets.filter("entity_id = 'S2-c'"))
    assert wide.columns[4:] == fuzzy.FEATURES and wide.filter("target_id = 'S2-a' and rid = 'S1-a'").first()["address_exact"] == 1.0


def test_wide_features_pass_on_texts_not_terms(spark):
    refs, targets = _registers(spark)
    fused = ranked.fuse(ranked.search_records(ranked.record_fields(targets), ranked.record_fields(refs)))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = linkage.wide_pairs(fused, refs, targets.filter("entity_id = 'S2-a'"), targets.filter("entity_id = 'S2-c'"))
        stack, passed = [wide._jdf.queryExecution().sparkPlan()], []
        while stack:
            node = stack.pop()
            stack += [node.children().apply(k) for k in range(node.children().size())]
            if "Join" in node.nodeName() or "EvalPython" in node.nodeName():
                passed.append(node.schema().simpleString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert len(passed) >= 3 and not any("grams_" in x or "words_" in x for x in passed)


def test_one_pass_over_hits_equals_every_view_alone(spark):
    """Scores of views that share fields, against sums term by term."""
    refs, targets = (ranked.record_fields(x) for x in _registers(spark))
    indexed = ranked.index(refs, list(ranked.VIEWS["joint"]))
    weight = {(r["rid"], r["field"], r["term"]): r["weight"] for r in indexed.collect()}
    country = {r["entity_id"]: r["country"] for r in refs.collect()}
    want = {}
    for t in targets.collect():
        for view, boosts in ranked.VIEWS.items():
            for rid in country:
                got = [b * weight[rid, f, x] for f, b in boosts.items() for x in t[f] if (rid, f, x) in weight and country[rid] == t["country"]]
                if got:
                    want[t["entity_id"], view, rid] = round(sum(got), 5)
    found = {(r["target_id"], r["view"], r["rid"]): round(r["score"], 5) for r in ranked.search(targets, indexed).collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], abs=2e-5) for k in want)


def test_tiles_give_what_an_index_gives(spark, sf, monkeypatch):
    """Records searched in many small tiles, against the search of an index; and whole runs make no row of a hit."""
    from linkloom.plans import catalogue, registry

    s1, s2, s3 = (ranked.record_fields(x) for x in registry.sources(spark, sf))
    rows = lambda df: {(r["target_id"], r["view"], r["view_rank"], r["rid"], round(r["score"], 5)) for r in df.collect()}
    want = rows(ranked.search(s2, ranked.index(s1, list(ranked.VIEWS["joint"]))))
    for size, least in (((7, 5), 3), ((65_536, 32_768), 4)):
        for name, value in zip(("TILE_REFERENCES", "TILE_TARGETS", "LEAST_TILES"), (*size, least), strict=True):
            monkeypatch.setattr(ranked, name, value)
        got = rows(ranked.search_records(s2, s1))
        assert {x[:4] for x in got} == {x[:4] for x in want} and len(got) == len(want)
    assert ranked.search_records(s2.limit(0), s1).count() == 0 == ranked.search_records(s2, s1.limit(0)).count()
    for name in ("bm25_views_topk", "rrf_fuse", "retrieval_audit"):
        plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Join Inner, (((country" not in plan


def test_terms_that_most_pairs_share_are_summed_by_products(monkeypatch):
    """A tile against sums made one by one; only terms of few pairs are added reference by reference."""
    import numpy as np
    import pyarrow as pa

    from linkloom.operators import tiles

    rng = np.random.default_rng(3)
    n, common, rare, boosts = 2500, 20, 4000, {"joint": [(1.0, 1.5), None, (0.8, 1.0), None], "name": [(1.0, 1.2), None, None, None]}
    key = lambda k: (k + 1) * 16 + (8 if k % 2 else 0)  # noqa: E731  of two families
    def record(c, r):
        terms = np.concatenate([rng.choice(common, c, replace=False), common + rng.choice(rare, r, replace=False)])
        return np.array([key(int(k)) | int(rng.choice([1, 2, 3, 3])) for k in terms], np.int64)
    refs, targets = [record(12, 4) for _ in range(n)], [record(12, 6) for _ in range(40)]
    words = np.concatenate(refs)
    keys, where = np.unique(words & ~np.int64(3), return_inverse=True)
    d = [np.bincount(where, weights=(words >> k) & 1).astype(np.int64) for k in (0, 1)]
    totals = np.array([n, *[sum(int(((w >> 2 & 3 == f) & (w >> k & 1 == 1)).sum()) for w in refs) or 1 for f in range(4) for k in (0, 1)]])
    ids = lambda rows, name: pa.array([f"{name}{k:05}" for k in range(len(rows))])
    added = []
    gain = tiles.Tile._gain
    monkeypatch.setattr(tiles.Tile, "_gain", lambda self, view, p, flags: added.append(int(self.keys[p])) or gain(self, view, p, flags))
    tile = tiles.Tile(boosts, 24, 6, 1.2, 0.75)
    tile.add(tiles.TOTALS, pa.array([None], pa.string()), totals, np.array([len(totals)]))
    tile.add(tiles.TERMS, pa.array([None], pa.string()), np.stack([keys, *d], axis=1).ravel(), np.array([3 * len(keys)]))
    tile.add(tiles.REFERENCES, ids(refs, "r"), words, np.array([len(w) for w in refs]))
    tile.finish()
    added.clear()
    targets[7] = targets[6]  # a copy
    got = tile.search(ids(targets, "t"), np.concatenate(targets), np.array([len(t) for t in targets])).to_pylist()
    assert added and not set(added) & {key(k) for k in range(common)}

    idf = [dict(zip(keys.tolist(), np.log(1 + (n - x + 0.5) / (x + 0.5)).tolist(), strict=True)) for x in d]
    weight = []
    for w in refs:
        of = {}
        for x in w.tolist():
            for k in (0, 1):
                if x >> k & 1:
                    f = x >> 2 & 3
                    length = sum(y >> 2 & 3 == f and y >> k & 1 for y in w.tolist())
                    of[x & ~3, k] = idf[k][x & ~3] * 2.2 / (1 + 1.2 * (0.25 + 0.75 * length / (totals[1 + 2 * f + k] / n)))
        weight.append(of)
    want = []
    for t, target in enumerate(targets):
        for view, by in boosts.items():
            sums = [sum(by[x >> 2 & 3][k] * of.get((x & ~3, k), 0.0) for x in target.tolist() if by[x >> 2 & 3] for k in (0, 1) if x >> k & 1) for of in weight]
            scores = [round(s * 1e6) / 1e6 for s in sums]
            for rank, r in enumerate(sorted((r for r in range(n) if sums[r] > 0), key=lambda r: (-scores[r], r))[:24]):
                want.append((f"t{t:05}", view, f"r{r:05}", pytest.approx(scores[r], abs=2e-6), rank + 1))
    assert [(r["target_id"], r["view"], r["rid"], r["score"], r["view_rank"]) for r in got] == want


def test_terms_of_references_are_found_once(spark, sf):
    """Frequencies, sums and tiles read them from one kept table, in which no filter finds them again."""
    from linkloom.plans import registry

    s1, s2, _ = (ranked.record_fields(x) for x in registry.sources(spark, sf))
    plan = ranked.search_records(s2, s1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") >= 3 and not any("Filter" in x and "array_intersect" in x for x in plan.splitlines())


def test_retrieval_audit(spark, tmp_path):
    from linkloom.operators import folds

    refs, targets = _registers(spark)
    edges = spark.createDataFrame([("S1-a", "S2-a"), ("S1-c", "S2-c"), ("S1-b", "S3-f")], "source1_id string, target_id string")
    parts = ranked.audit(targets, refs, edges, folds.blake_fold, 1)
    recall = {(r["country"], r["view"], r["k"]): r["recall"] for r in parts["by_country"].collect()}
    assert recall["US", "union", 1] == 1.0 and recall["Nowhere", "union", 24] == 0.0
    lost = parts["misses"].collect()
    assert [(r["target_id"], r["true_name"]) for r in lost] == [("S3-f", "Marlow Ferries")]
    ranked.write_audit(parts, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit" / "retrieved")).count() == parts["retrieved"].count()
    some = ranked.sampled_edges(edges, folds.blake_fold, 3).count()
    assert sum(edges.filter(folds.blake_fold(F.col("source1_id"), 3) == k).count() for k in range(3)) == 3 and some <= 3


def test_ordinals_accounts_and_shards(spark, tmp_path):
    rows = spark.createDataFrame([(f"S1-{k:03}",) for k in range(500)], "entity_id string").repartition(7)
    placed = ordinal.with_ordinal(rows.orderBy("entity_id"))
    assert {(r["entity_id"], r["ordinal"]) for r in placed.collect()} == {(f"S1-{k:03}", k) for k in range(500)}
    two = ordinal.with_sequence([rows.filter("entity_id < 'S1-200'").orderBy("entity_id"), rows.filter("entity_id >= 'S1-200'").orderBy("entity_id")])
    assert ordinal.assert_dense(two) == 500 and {r["seq"] for r in two.filter("entity_id = 'S1-200'").collect()} == {200}
    for bad in (two.filter("seq <> 3"), two.unionByName(two.limit(1)), two.withColumn("seq", F.col("seq") + 1)):
        with pytest.raises(contracts.ContractError):
            ordinal.assert_dense(bad)
    assert ordinal.assert_dense(two.limit(0)) == 0
    targets = spark.createDataFrame([("S2-1", "S2"), ("S2-2", "S2"), ("S3-1", "S3")], "entity_id string, target_source string")
    lists = placed.select(F.col("entity_id").alias("source1_entity_id"), F.when(F.col("ordinal") < 2, F.lit("S2-1,S3-1")).otherwise("").alias("matched_entity_ids"), "ordinal")
    account = contracts.validate_matches(lists, placed, targets)
    assert (account["rows"], account["matched_pairs"], account["empty_rows"], account["targets_s2"], account["targets_s3"]) == (500, 4, 498, 2, 1)
    swapped = lists.withColumn("ordinal", F.when(F.col("ordinal") < 2, 1 - F.col("ordinal")).otherwise(F.col("ordinal")))
    for bad in (swapped, lists.filter("ordinal < 499"), lists.unionByName(lists.limit(1)), lists.withColumn("matched_entity_ids", F.lit("S2-9"))):
        with pytest.raises(contracts.ContractError):
            contracts.validate_matches(bad, placed, targets)
    path = str(tmp_path / "shards")
    for k in range(3):
        tables.write_shard(placed.filter(F.col("ordinal") % 3 == k), path, k, 3, pairs=10 * k)
    df, total = tables.finalize_shards(spark, path, 3, 500)
    assert df.count() == 500 and total == {"rows": 500, "pairs": 30}
    with pytest.raises(tables.ShardError):
        tables.finalize_shards(spark, path, 3, 499)
    with pytest.raises(tables.ShardError):
        tables.finalize_shards(spark, path, 4)
    with pytest.raises(tables.ShardError):
        tables.finalize_shards(spark, path, 2)


def test_ordinals_of_many_partitions(spark):
    """Partitions of a sorted table differ by what is read of it: places must not."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    for c, v in zip(before, ("32", "64k", "16k"), strict=True):
        spark.conf.set(c, v)
    try:
        rows = spark.range(20_000).select(F.format_string("S1-%05d", "id").alias("entity_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("x"))
        placed = ordinal.with_ordinal(rows.orderBy("entity_id"))
        assert [(r["entity_id"], r["ordinal"]) for r in placed.select("entity_id", "ordinal").orderBy("entity_id").collect()] == [(f"S1-{k:05}", k) for k in range(20_000)]
        assert {r["x"] is None for r in placed.collect()} == {False} and len(placed.collect()) == 20_000
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_cross_fit(spark):
    rows = [(f"q{k % 40}", f"t{k}", k % 12 + 1, k % 5, (k // 5) % 5, float(k % 7) + (k % 3 == 0) * 5, int(k % 3 == 0)) for k in range(400)]
    pairs = spark.createDataFrame(rows, "source1_id string, target_id string, candidate_rank int, fold int, rid_fold int, x double, label int")
    got = model.cross_fit(pairs, ["x"], maxIter=4, maxDepth=2, minInstancesPerNode=1)
    assert got.oof.count() == 400 and got.oof.filter("probability is null").isEmpty() and len(got.models) == 5
    assert got.final_rounds(2) == max(2, sorted(got.rounds)[2]) and got.final_rounds() == 150
    assert model.fit_final(pairs, ["x"], got, least=3, maxDepth=2).getNumTrees >= 3
    with pytest.raises(contracts.ContractError):
        model.cross_fit(pairs.withColumn("fold", F.when(F.col("fold") == 1, None).otherwise(F.col("fold"))), ["x"], maxIter=1)
    with pytest.raises(model.OneClassError):
        model.cross_fit(pairs.filter("fold <> 2"), ["x"], maxIter=1, maxDepth=1)


def test_folds_are_fitted_at_the_same_time(spark, monkeypatch):
    """Each fit waits for the others; models are those of fits one by one."""
    from threading import Barrier

    rows = [(k % 12 + 1, k % 2, (k // 2) % 3, float(k % 7) + (k % 5 == 0) * 5, int(k % 5 == 0)) for k in range(120)]
    pairs = spark.createDataFrame(rows, "candidate_rank int, fold int, rid_fold int, x double, label int")
    fit, together = model.fit, Barrier(2, timeout=60)

    def waiting(*args, **kw):
        together.wait()
        return fit(*args, **kw)

    monkeypatch.setattr(model, "fit", waiting)
    got = model.cross_fit(pairs, ["x"], 2, maxIter=2, maxDepth=1, minInstancesPerNode=1)
    own = pairs.withColumn("_held", F.col("fold") == 1).filter("_held or (rid_fold <> 1 and candidate_rank <= 8)")
    alone = fit(own, ["x"], validation="_held", maxIter=2, maxDepth=1, minInstancesPerNode=1)
    assert got.models[1].toDebugString.split("\n")[1:] == alone.toDebugString.split("\n")[1:]


def test_model_is_saved(spark, tmp_path):
    pairs = spark.createDataFrame([(float(k), k % 2) for k in range(20)], "x double, label int")
    fitted = model.fit(pairs, ["x"], maxIter=2, maxDepth=2, minInstancesPerNode=1)
    model.save(fitted, str(tmp_path / "model"))
    same = model.load(str(tmp_path / "model"))
    assert [r["probability"] for r in model.score(same, pairs, ["x"]).collect()] == [r["probability"] for r in model.score(fitted, pairs, ["x"]).collect()]


def test_filled_text():
    metrics = {"point": {"cap": 4, "f": 0.91234567}, "pairs": 1234567}
    assert reports.filled("cap [[point.cap]], F [[point.f:.4f]], [[pairs:,]] pairs", metrics) == "cap 4, F 0.9123, 1,234,567 pairs"
    for bad in ("[[point.none]]", "[[pairs.x]]"):
        with pytest.raises(KeyError):
            reports.filled(bad, metrics)


def test_kept_tables_are_let_go(spark):
    from linkloom.operators import keep

    outer = keep.keep(spark.range(3))
    with keep.holding():
        inner = keep.keep(spark.range(5).withColumn("x", F.lit(1)))
        assert inner.is_cached
    assert not inner.is_cached and outer.is_cached
    keep.release()
    assert not outer.is_cached


def test_frequent_values_go_before_the_joins(small, monkeypatch):
    from linkloom.operators import retrieval
    from linkloom.operators.blocking import BASE

    q, t = linkage.prepared(small["S1"], small["S2"], small["S3"], BASE)
    got = []
    for most in (0, 3, 10_000):
        monkeypatch.setattr(retrieval.without_hot, "__defaults__", (most,))
        got.append(sorted(map(str, retrieval.candidates(q, t, BASE).collect())))
    assert got[0] == got[1] == got[2] and got[0]


def test_rule_linkage_finds_the_copies(small):
    run = linkage.rule_linkage(small["S1"], small["S2"], small["S3"]).check()
    got = {(r["source1_id"], r["target_id"]) for r in run.matches.collect()}
    want = {tuple(r) for r in truth.truth_edges(small["truth"]).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want)
    assert contracts.validate_lists(run.candidate_lists(), run.queries, 32) == (60, 0)
    assert run.match_lists().count() == 60


def test_boosted_linkage(spark, small):
    train, edges = (small["S1"], small["S2"], small["S3"]), truth.truth_edges(small["truth"])
    run = linkage.boosted_linkage(train, edges, train, smoke=True, maxIter=3, maxDepth=2, minInstancesPerNode=1)
    assert run.check(exclusive=False).match_lists().count() == 60 and run.metrics["operating_point"]["macro_f0_5"] > 0.5
    with pytest.raises(model.OneClassError):
        model.fit(spark.createDataFrame([(1.0, 1)], "x double, label int"), ["x"])


def test_sources(spark, tmp_path, small):
    path = str(tmp_path / "part.tsv")
    (tmp_path / "part.tsv").write_text('﻿entity_id\tbusiness_name\tbusiness_address\tcountry\textra\n S1-1 \t"Open quote\t\tUS\tx\n\tno id\t\t\t\n', encoding="utf-8")
    rows = tables.read_source(spark, path).collect()
    assert len(rows) == 1 and rows[0]["entity_id"] == "S1-1" and rows[0]["business_name"] == '"Open quote'
    (tmp_path / "quoted.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\t"Tab\tinside"\tx\tUS\n', encoding="utf-8")
    assert tables.read_records(spark, str(tmp_path / "quoted.tsv"), quote=True).first()["business_name"] == "Tab\tinside"
    lists = spark.createDataFrame([("a", "x,y"), ("b", "")], "source1_entity_id string, matched_entity_ids string")
    tables.write_tsv(lists, str(tmp_path / "parts"), 2)
    assert sorted(map(tuple, tables.read_parts(spark, str(tmp_path / "parts"), tables.TRUTH.names).collect())) == [("a", "x,y"), ("b", "")]
    assert tables.merge_parts(spark, str(tmp_path / "parts"), str(tmp_path / "all.tsv"), tables.TRUTH.names) == 2
    with pytest.raises(FileExistsError):
        tables.write_one_tsv(lists, str(tmp_path / "all.tsv"))
    with pytest.raises(tables.HeaderError):
        tables.read_parts(spark, str(tmp_path / "parts"), ["other", "names"])
    (tmp_path / "mixed").mkdir()
    for k, head in enumerate(["a\tb", "a\tb", "a\tc"]):
        (tmp_path / "mixed" / f"part-{k}.csv").write_text(f"{head}\n1\t2\n", encoding="utf-8")
    with pytest.raises(tables.HeaderError):
        tables.read_parts(spark, str(tmp_path / "mixed"), ["a", "b"])
    tables.write_json(spark, {"a": [1, 2]}, str(tmp_path / "m"))
    assert tables.read_json(spark, str(tmp_path / "m")) == {"a": [1, 2]}
    tables.write_features(lists, str(tmp_path / "f1"))
    tables.write_features(lists.withColumn("z", F.lit(1)), str(tmp_path / "f2"))
    assert tables.merge_shards(spark, [str(tmp_path / "f1")] * 2).count() == 4
    with pytest.raises(ValueError):
        tables.merge_shards(spark, [str(tmp_path / "f1"), str(tmp_path / "f2")])
    refs = small["S1"]
    indexed = ranked.index(ranked.record_fields(refs), ["nw"])
    tables.save_index(indexed, refs, str(tmp_path / "index"))
    assert tables.load_index(spark, str(tmp_path / "index"), refs).count() == indexed.count()
    with pytest.raises(ValueError):
        tables.load_index(spark, str(tmp_path / "index"), small["S2"])


def test_reports(spark):
    counts = spark.createDataFrame([("US", n) for n in range(1, 11)], "country string, n int")
    assert tuple(reports.distribution(counts).first()) == (5.5, 5, 10, 10, 10)
    assert reports.distribution_linear(counts).first()["p50"] == 5.5


@pytest.mark.parametrize("name, folds", [("gbt_fit_score", None), ("crossfit_oof", 5)])
def test_registered_models_are_the_whole_pair_model(spark, sf, monkeypatch, name, folds):
    class Told(Exception):
        pass

    def fit(pairs, features, *own, **settings):
        raise Told(own, settings)

    monkeypatch.setattr(catalogue.model, "cross_fit" if folds else "fit", fit)
    with pytest.raises(Told) as told:
        catalogue.QUERIES[name](spark, sf)
    own, settings = told.value.args
    assert model.TREES | settings == model.TREES and own == ((folds,) if folds else ())
    spark.catalog.clearCache()
