"""Baskets, FPGrowth rules and recommendations (A6, R1-R11, J8) against brute force."""

import itertools
import math
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll.sources.fixtures import transactions

from conftest import SF_SMALL


def py_baskets(spark, item):
    b = ops.baskets(transactions(spark, SF_SMALL, item)).collect()
    return [(tuple(r[c] for c in ("InvoiceNo", "InvoiceDate", "CustomerID", "Country")), frozenset(r["items"]))
            for r in b]


def brute_itemsets(baskets, min_support):
    n = len(baskets)
    min_count = math.ceil(min_support * n)
    counts = Counter()
    for _, items in baskets:
        s = sorted(items)
        for k in range(1, len(s) + 1):
            for combo in itertools.combinations(s, k):
                counts[combo] += 1
    return {k: v for k, v in counts.items() if v >= min_count}, n


def brute_rules(itemsets, n, min_confidence):
    out = {}
    for items, freq in itemsets.items():
        if len(items) < 2:
            continue
        for c in items:
            ante = tuple(x for x in items if x != c)
            conf = freq / itemsets[ante]
            if conf >= min_confidence:
                out[(ante, c)] = conf
    return out


def test_baskets_are_sorted_sets(spark):
    for _, items in py_baskets(spark, "p_brand"):
        assert len(items) > 0
    b = ops.baskets(transactions(spark, SF_SMALL)).first()["items"]
    assert b == sorted(set(b))


def test_itemsets_and_rules_match_brute_force(spark):
    baskets = py_baskets(spark, "p_type")
    itemsets, n = brute_itemsets(baskets, 0.01)
    rules = brute_rules(itemsets, n, 0.2)
    rs = ops.mine_rules(ops.baskets(transactions(spark, SF_SMALL, "p_type")), 0.01, 0.2)
    got_sets = {tuple(r["items"]): r["freq"] for r in rs.itemsets.collect()}
    assert got_sets == itemsets
    got_rules = {(tuple(r["antecedent"]), r["consequent"][0]): r["confidence"] for r in rs.rules.collect()}
    assert got_rules.keys() == rules.keys()
    for k, v in rules.items():
        assert got_rules[k] == v  # same double division
    lifts = {(tuple(r["antecedent"]), r["consequent"][0]): (r["lift"], r["support"]) for r in rs.rules.collect()}
    for (ante, c), (lift, support) in lifts.items():
        assert lift == rules[(ante, c)] / (itemsets[(c,)] / n)
        assert support == itemsets[tuple(sorted(ante + (c,)))] / n


def test_frequently_bought_equals_pair_counts(spark):
    baskets = py_baskets(spark, "p_brand")
    itemsets, n = brute_itemsets(baskets, 0.01)
    rules = brute_rules(itemsets, n, 0.2)
    expected = defaultdict(list)
    for (ante, c), conf in rules.items():
        if len(ante) == 1:
            expected[ante[0]].append((-conf, c))
    expected = {k: ",".join(c for _, c in sorted(v)) for k, v in expected.items()}
    got = {r["StockCode"]: r["recs"] for r in
           ops.general_recommendations(transactions(spark, SF_SMALL), 0.01, 0.2).collect()}
    assert got == expected and len(got) > 0


def test_recommend_equals_brute_force(spark):
    tx = transactions(spark, SF_SMALL, "p_type")
    b = ops.baskets(tx)
    rs = ops.mine_rules(b, 0.01, 0.2)
    rules = [(frozenset(r["antecedent"]), r["consequent"][0], r["confidence"]) for r in rs.rules.collect()]
    expected = {}
    for key, items in py_baskets(spark, "p_type"):
        best = {}
        for ante, c, conf in rules:
            if ante <= items and c not in items:
                best[c] = max(best.get(c, -1.0), conf)
        if best:
            expected[key] = [c for c, _ in sorted(best.items(), key=lambda kv: (-kv[1], kv[0]))]
    got = {tuple(r[c] for c in ("InvoiceNo", "InvoiceDate", "CustomerID", "Country")): r["recs"]
           for r in ops.recommend(b, rs.rules).collect()}
    assert got == expected and len(got) > 0
    # forced shuffle path (no broadcast) gives the same
    got2 = {tuple(r[c] for c in ("InvoiceNo", "InvoiceDate", "CustomerID", "Country")): r["recs"]
            for r in ops.recommend(b, rs.rules, max_broadcast_bytes=0).collect()}
    assert got2 == expected
    kept = ops.recommend(b, rs.rules, keep_empty=True)
    assert kept.count() == b.count()


def test_merge_recommendations(spark):
    seg = spark.createDataFrame([("A", "x,y"), ("B", "z")], "StockCode string, recs string")
    gen = spark.createDataFrame([("A", "y,w,x,v"), ("C", "q")], "StockCode string, recs string")
    got = {r["StockCode"]: r["recs"] for r in ops.merge_recommendations(seg, gen).collect()}
    assert got == {"A": "x,y,w,v", "B": "z", "C": "q"}


def test_segment_runs_match_single_runs(spark):
    tx = transactions(spark, SF_SMALL)
    segments = ops.segment_customers(tx)
    res = ops.recommendations_by_segment(tx, ["1", "2"], general=True, min_support=0.02, min_confidence=0.15)
    gen = {r["StockCode"]: r["recs"] for r in res["gen"].collect()}
    assert gen == {r["StockCode"]: r["recs"] for r in
                   ops.general_recommendations(tx, 0.02, 0.15).collect()}
    for label in ("1", "2"):
        single = {r["StockCode"]: r["recs"] for r in
                  ops.segment_recommendations(tx, segments, label, 0.02, 0.15,
                                              fill=ops.general_recommendations(tx, 0.02, 0.15)).collect()}
        assert {r["StockCode"]: r["recs"] for r in res[label].collect()} == single
    assert res["segments"].filter(F.col("segment").isin("1", "2")).count() == res["segments"].count()


def test_empty_segment_mines_nothing(spark):
    tx = transactions(spark, SF_SMALL)
    nobody = spark.createDataFrame([], "CustomerID string, segment string")
    recs = ops.segment_recommendations(tx, nobody, "1", 0.02, 0.15)
    assert recs.count() == 0
    gen = ops.general_recommendations(tx, 0.02, 0.15)
    filled = ops.segment_recommendations(tx, nobody, "1", 0.02, 0.15, fill=gen)
    assert {tuple(r) for r in filled.collect()} == {tuple(r) for r in gen.collect()}


def test_recommend_requires_array_items(spark):
    import pytest
    bad = spark.createDataFrame([("1", "A")], "InvoiceNo string, items string")
    rules = spark.createDataFrame([(["A"], ["B"], 0.5)], "antecedent array<string>, consequent array<string>, confidence double")
    with pytest.raises(TypeError):
        ops.recommend(bad, rules, key_cols=["InvoiceNo"])
    good = spark.createDataFrame([("1", ["A"]), ("2", ["A", "B"]), ("3", ["C"])], "InvoiceNo string, items array<string>")
    got = {r["InvoiceNo"]: r["recs"] for r in ops.recommend(good, rules, key_cols=["InvoiceNo"]).collect()}
    assert got == {"1": ["B"]}


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_thresholds_of_the_rule_queries_reject(spark, sf):
    """Of the sets of three and the rules with two items some pass and some do not."""
    from tillroll.queries import TYPE_CONFIDENCE, TYPE_SUPPORT
    b = ops.baskets(transactions(spark, sf, "p_type"))
    every = ops.mine_rules(b, 0.01, 0.01)
    some = ops.mine_rules(b, TYPE_SUPPORT, TYPE_CONFIDENCE)
    size = lambda df, col, n: df.where(F.size(col) == n).count()
    assert 0 < size(some.itemsets, "items", 3) < size(every.itemsets, "items", 3)
    for n in (1, 2):
        kept = size(some.rules, "antecedent", n)
        frequent = every.rules.where((F.size("antecedent") == n) & (F.col("support") >= TYPE_SUPPORT)).count()
        assert 0 < kept < frequent


def test_pair_rules_equal_one_item_rules(spark):
    b = ops.baskets(transactions(spark, SF_SMALL))
    pairs = sorted(map(tuple, ops.mine_pair_rules(b, 0.01, 0.1).collect()))
    rules = sorted(map(tuple, ops.one_item_rules(ops.mine_rules(b, 0.01, 0.1).rules).collect()))
    assert pairs == rules and len(pairs) > 100


def test_recommend_looks_antecedents_up_once(spark):
    """One row per basket and antecedent at most: under its rarest item; no joins after the aggregation."""
    b = ops.baskets(transactions(spark, SF_SMALL, "p_type"))
    rules = ops.mine_rules(b, 0.01, 0.2).rules
    index = ops.rule_index(rules)
    assert index.count() == rules.select("antecedent").distinct().count()
    counts = {r[0]: r[1] for r in b.select(F.explode("items")).groupBy("col").count().collect()}
    for r in index.collect():
        assert counts[r["_item"]] == min(counts[x] for x in r["_ante"])
    plan = ops.recommend(b, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and "SortMergeJoin [_item" not in plan


def plain_pairs(baskets, min_support, min_confidence):
    least = math.ceil(min_support * len(baskets))
    one, two = Counter(x for b in baskets for x in b), Counter(p for b in baskets for p in itertools.combinations(sorted(b), 2))
    return {(a, c, n / one[a]) for (x, y), n in two.items() if n >= least
            for a, c in ((x, y), (y, x)) if n / one[a] >= min_confidence}


def test_pairs_of_a_very_large_purchase(spark):
    """2,000 items in one purchase: its pairs are dealt in blocks, and no itemset is grown."""
    import random
    rng = random.Random(1)
    every = [f"i{k:04}" for k in range(2000)]
    baskets = [every] + [rng.sample(every[:300], rng.randint(0, 30)) for _ in range(60)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    got = {tuple(r) for r in ops.mine_pair_rules(df, 2 / 61, 0.3).collect()}
    assert got == plain_pairs(baskets, 2 / 61, 0.3) and len(got) > 1000


@pytest.mark.parametrize("block", [1, 3, 128])
def test_pairs_of_all_labels_in_one_count(spark, monkeypatch, block):
    import random

    mod = sys.modules["tillroll.operators.baskets"]
    monkeypatch.setattr(mod, "PAIR_BLOCK", block)
    rng = random.Random(block)
    rows = [(rng.choice("xyz"), rng.sample("abcdefghij", rng.randint(0, 8))) for _ in range(200)]
    df = spark.createDataFrame(rows, "kind string, items array<string>")
    got = {tuple(r) for r in ops.pair_rules(df, 0.1, 0.3, label_col="kind").collect()}
    want = {(k, *p) for k in "xyz" for p in plain_pairs([b for x, b in rows if x == k], 0.1, 0.3)}
    assert got == want and want


def test_pair_rules_grow_no_itemsets(spark, monkeypatch):
    mod = sys.modules["tillroll.operators.baskets"]
    monkeypatch.setattr(mod, "fit_rules", None)  # FPGrowth would fail
    tx = transactions(spark, SF_SMALL)
    assert ops.general_recommendations(tx, 0.02, 0.15).count() > 0
    res = ops.recommendations_by_segment(tx, ["1", "2"], general=True, min_support=0.02, min_confidence=0.15)
    assert all(res[k].count() > 0 for k in ("gen", "1", "2"))


def test_items_with_a_comma_stay_whole(spark):
    rules = spark.createDataFrame([("A", "x, large", 0.9), ("A", "y", 0.5), ("B", "z", 0.4)], "_item string, _cons string, confidence double")
    gen = spark.createDataFrame([("A", "x, large", 0.8), ("A", "w", 0.7), ("C", "q,r", 0.4)], "_item string, _cons string, confidence double")
    lists = lambda r: ops.frequently_bought(r, as_array=True)
    got = {r["StockCode"]: r["recs"] for r in ops.merge_recommendations(lists(rules), lists(gen), as_array=True).collect()}
    assert got == {"A": ["x, large", "y", "w"], "B": ["z"], "C": ["q,r"]}
    text = {r["StockCode"]: r["recs"] for r in ops.merge_recommendations(lists(rules), lists(gen)).collect()}
    assert text == {"A": "x, large,y,w", "B": "z", "C": "q,r"}
    assert {r["StockCode"]: r["recs"] for r in ops.merge_recommendations(ops.frequently_bought(rules), lists(gen)).collect()}["B"] == "z"


def test_recommend_descends_the_tree_without_arrays(spark, monkeypatch):
    """Rows of the levels are a number and a node; broadcast or shuffled, null and empty baskets included."""
    mod = sys.modules["tillroll.operators.recommend"]
    b = [("1", ["A", "B", "C"]), ("2", ["B", "A"]), ("3", []), ("4", None), ("5", ["C", None, "D"]), ("6", ["D", "C", "B", "A", "E"])]
    df = spark.createDataFrame(b, "InvoiceNo string, items array<string>")
    r = [(["A"], ["E"], 0.5), (["A", "B"], ["D"], 0.6), (["A", "B", "C"], ["F"], 0.7), (["C", "D"], ["A"], 0.4), (["B", "C"], ["F"], 0.9)]
    rules = spark.createDataFrame(r, "antecedent array<string>, consequent array<string>, confidence double")
    seen, real = [], mod.cut_lineage
    monkeypatch.setattr(mod, "cut_lineage", lambda s, d, name, *a: seen.append((name, d.columns)) or real(s, d, name, *a))
    want = {}
    for key, items in b:
        best = {}
        for ante, cons, conf in r:
            if items and set(ante) <= set(items) and cons[0] not in items:
                best[cons[0]] = max(best.get(cons[0], 0), conf)
        want[key] = [c for c, _ in sorted(best.items(), key=lambda x: (-x[1], x[0]))]
    for most in (0, 1 << 20):
        got = {x["InvoiceNo"]: x["recs"] for x in ops.recommend(df, rules, ["InvoiceNo"], keep_empty=True, max_broadcast_bytes=most).collect()}
        assert got == want
        some = {x["InvoiceNo"]: x["recs"] for x in ops.recommend(df, rules, ["InvoiceNo"], max_broadcast_bytes=most).collect()}
        assert some == {k: v for k, v in want.items() if v}
    levels = [c for name, c in seen if name.startswith("antecedent-level")]
    assert levels and all(c == ["_basket", "_node"] for c in levels)


def test_broadcast_check_moves_one_row_a_task(spark):
    from tillroll.plans.strategies import broadcast_if_bounded, cut_lineage, row_bytes
    df = cut_lineage(spark, spark.range(0, 1000, 1, 4).selectExpr("id", "cast(id as string) AS t"), "checked")
    assert broadcast_if_bounded(df)[1] and not broadcast_if_bounded(df, 1000)[1]
    plan = df.agg(F.sum(row_bytes(df.schema)))._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "partial_sum" in plan
