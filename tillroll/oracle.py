"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator semantics, not from the Spark plans: pair and
itemset counts by self-join or power set, relational division by
``list_has_all``, merges by ``list_filter``.  Tables are the test views
(region, nation, customer, part, orders, lineitem, embeddings ...).
"""

from __future__ import annotations

from tillroll.schema import CUSTOMER_FEATURES, SCALED_PREFIX

SUPPORT = 0.01
CONFIDENCE = 0.2
BRAND_SUPPORT = 0.02
BRAND_CONFIDENCE = 0.15
TYPE_SUPPORT = 0.117
TYPE_CONFIDENCE = 0.487
SEGMENT_SUPPORT, SEGMENT_CONFIDENCE = 0.017, 0.13
RAW_SUPPORT, RAW_CONFIDENCE = 0.014, 0.117

_FROM = """lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey"""


def tx_sql(item: str = "p_brand") -> str:
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS InvoiceNo, {item} AS StockCode, p_name AS Description,
       CAST(l_quantity AS INTEGER) AS Quantity, o_orderdate AS InvoiceDate,
       l_extendedprice / l_quantity AS UnitPrice, CAST(o_custkey AS VARCHAR) AS CustomerID,
       n_name AS Country
    FROM {_FROM}"""


def raw_sql(item: str = "p_brand") -> str:
    return f"""SELECT
       CASE WHEN l_orderkey % 23 = 0 THEN concat('C', CAST(l_orderkey AS VARCHAR))
            ELSE CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
       CASE WHEN l_partkey % 29 = 0 THEN 'POST' WHEN l_partkey % 31 = 0 THEN '' ELSE {item} END AS StockCode,
       p_name AS Description,
       CASE WHEN l_orderkey % 19 = 0 THEN concat('-', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR))
            WHEN l_orderkey % 37 = 0 THEN 'n/a'
            WHEN l_orderkey % 67 = 0 THEN concat(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '.7')
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS Quantity,
       CASE WHEN l_orderkey % 53 = 0 THEN 'bad date' WHEN l_orderkey % 59 = 0 THEN NULL
            ELSE strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') END AS InvoiceDate,
       CASE WHEN l_partkey % 41 = 0 THEN '0.0'
            ELSE concat(CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS VARCHAR), '.5') END AS UnitPrice,
       CASE WHEN o_custkey % 43 = 0 THEN NULL WHEN o_custkey % 47 = 0 THEN ''
            ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
       n_name AS Country
    FROM {_FROM}"""


def clean_sql(raw: str) -> str:
    return f"""SELECT * FROM (
      SELECT InvoiceNo, StockCode, Description,
             TRY_CAST(regexp_replace(Quantity, '[.][0-9]*$', '') AS INTEGER) AS Quantity, InvoiceDate,
             TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country FROM {raw}) t
    WHERE StockCode IS NOT NULL AND StockCode <> '' AND InvoiceDate IS NOT NULL AND InvoiceDate <> ''
      AND CustomerID IS NOT NULL AND CustomerID <> ''
      AND coalesce(regexp_full_match(CustomerID, '[0-9]+'), false)
      AND coalesce(regexp_full_match(InvoiceNo, '[0-9]+'), false)
      AND Quantity > 0 AND UnitPrice > 0
      AND coalesce(regexp_matches(StockCode, '\\p{{Nd}}'), false)"""


def loadable_sql(raw: str) -> str:
    return f"""SELECT StockCode, Description, TRY_CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID,
       coalesce(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M'), TIMESTAMP '2010-12-01 08:34:00') AS ts
    FROM {raw}
    WHERE StockCode IS NOT NULL AND StockCode <> '' AND TRY_CAST(UnitPrice AS DOUBLE) > 0
      AND CustomerID IS NOT NULL AND CustomerID <> ''"""


def segment_ctes(tx: str, p: str = "") -> str:
    """CTEs {p}pp, {p}pc, {p}sc, {p}sim, {p}seg over the transactions CTE ``tx``."""
    feats = ["purchasesPerCustomer", "avgPricePerPurchasePerCustomer",
             "avgProductsPerPurchasePerCustomer", "avgQuantityPerPurchasePerCustomer"]
    mm = ", ".join(f"CAST(min({f}) AS DOUBLE) AS mn_{f}, CAST(max({f}) AS DOUBLE) AS mx_{f}" for f in feats)
    scaled = ",\n       ".join(
        f"CASE WHEN mx_{f} = mn_{f} THEN CAST('NaN' AS DOUBLE) "
        f"ELSE ((CAST({f} AS DOUBLE) - mn_{f}) / (mx_{f} - mn_{f})) * 99.0 + 1.0 END AS scaled_{f}"
        for f in feats)
    dist = " + ".join(f"(1.0 - scaled_{f}) * (1.0 - scaled_{f})" for f in feats)
    return f"""{p}pp AS (
    SELECT InvoiceNo, InvoiceDate, CustomerID, Country, sum(UnitPrice * Quantity) AS pricePerPurchase,
           count(DISTINCT StockCode) AS productsPerPurchase, CAST(sum(Quantity) AS BIGINT) AS quantityPerPurchase
    FROM {tx} GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country),
  {p}pc AS (
    SELECT CustomerID, count(*) AS purchasesPerCustomer,
           avg(pricePerPurchase) AS avgPricePerPurchasePerCustomer,
           avg(productsPerPurchase) AS avgProductsPerPurchasePerCustomer,
           avg(quantityPerPurchase) AS avgQuantityPerPurchasePerCustomer
    FROM {p}pp GROUP BY CustomerID),
  {p}mm AS (SELECT {mm} FROM {p}pc),
  {p}sc AS (
    SELECT CustomerID, {', '.join(feats)},
       {scaled}
    FROM {p}pc CROSS JOIN {p}mm),
  {p}sim AS (SELECT CustomerID, sqrt(0.0 + {dist}) AS similarity FROM {p}sc),
  {p}seg AS (
    SELECT CustomerID, CASE WHEN similarity < (SELECT avg(similarity) FROM {p}sim) THEN '1' ELSE '2' END AS segment
    FROM {p}sim)"""


def pair_rules_ctes(tx: str, p: str, support: float = BRAND_SUPPORT, confidence: float = BRAND_CONFIDENCE) -> str:
    """One-item rules by pair counting; CTE {p}fb = (StockCode, recs)."""
    return f"""{p}b AS (SELECT DISTINCT InvoiceNo, InvoiceDate, CustomerID, Country, StockCode AS item
               FROM {tx} WHERE StockCode IS NOT NULL),
  {p}n AS (SELECT count(*) AS n FROM (SELECT DISTINCT InvoiceNo, InvoiceDate, CustomerID, Country FROM {tx}) q),
  {p}ic AS (SELECT item, count(*) AS cnt FROM {p}b GROUP BY item),
  {p}pc AS (SELECT x.item AS a, y.item AS c, count(*) AS cnt
            FROM {p}b x JOIN {p}b y ON x.InvoiceNo = y.InvoiceNo AND x.InvoiceDate = y.InvoiceDate
                 AND x.CustomerID = y.CustomerID AND x.Country = y.Country AND x.item <> y.item
            GROUP BY x.item, y.item),
  {p}r AS (SELECT pc.a, pc.c, CAST(pc.cnt AS DOUBLE) / ic.cnt AS confidence
           FROM {p}pc pc JOIN {p}ic ic ON pc.a = ic.item CROSS JOIN {p}n
           WHERE pc.cnt >= ceil(CAST({support} AS DOUBLE) * {p}n.n)
             AND CAST(pc.cnt AS DOUBLE) / ic.cnt >= CAST({confidence} AS DOUBLE)),
  {p}fb AS (SELECT a AS StockCode, string_agg(c, ',' ORDER BY confidence DESC, c) AS recs
            FROM {p}r GROUP BY a)"""


def itemset_ctes(tx: str, support: float = SUPPORT, confidence: float = CONFIDENCE) -> str:
    """All frequent itemsets (power set of frequent items, counted by
    containment) and all rules.  CTEs bk, fi (items, freq), ru."""
    return f"""bk AS (SELECT InvoiceNo, InvoiceDate, CustomerID, Country,
                list_sort(list_distinct(list(StockCode))) AS items
             FROM {tx} GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country),
  nb AS (SELECT count(*) AS n, ceil(CAST({support} AS DOUBLE) * count(*)) AS mc FROM bk),
  f1 AS (SELECT item FROM (SELECT unnest(items) AS item FROM bk) u GROUP BY item
         HAVING count(*) >= (SELECT mc FROM nb)),
  ps(s) AS (SELECT [item] FROM f1
            UNION ALL SELECT list_append(ps.s, f1.item) FROM ps JOIN f1 ON f1.item > ps.s[-1]),
  fi AS (SELECT ps.s AS items, count(*) AS freq FROM ps JOIN bk ON list_has_all(bk.items, ps.s)
         GROUP BY ps.s HAVING count(*) >= (SELECT mc FROM nb)),
  cand AS (SELECT items AS full_items, freq AS fu, cons,
                  list_filter(items, lambda x: x <> cons) AS ante
           FROM (SELECT items, freq, unnest(items) AS cons FROM fi WHERE len(items) >= 2) q),
  ru AS (SELECT c.ante AS antecedent, c.cons AS consequent,
                CAST(c.fu AS DOUBLE) / a.freq AS confidence,
                (CAST(c.fu AS DOUBLE) / a.freq) / (CAST(s1.freq AS DOUBLE) / nb.n) AS lift,
                CAST(c.fu AS DOUBLE) / nb.n AS support
         FROM cand c JOIN fi a ON a.items = c.ante JOIN fi s1 ON s1.items = [c.cons] CROSS JOIN nb
         WHERE CAST(c.fu AS DOUBLE) / a.freq >= CAST({confidence} AS DOUBLE))"""


def _merge_expr(s: str, g: str) -> str:
    return (f"CASE WHEN {s} IS NULL THEN {g} WHEN {g} IS NULL THEN {s} ELSE array_to_string(list_concat("
            f"string_split({s}, ','), list_filter(string_split({g}, ','), "
            f"lambda x: NOT list_contains(string_split({s}, ','), x))), ',') END")


def _segment_recs_ctes(tx: str, segs: str, p: str, label: str, support: float = SEGMENT_SUPPORT,
                       confidence: float = SEGMENT_CONFIDENCE) -> str:
    return (f"{p}tx AS (SELECT * FROM {tx} WHERE CustomerID IN "
            f"(SELECT CustomerID FROM {segs} WHERE segment = '{label}')),\n  "
            + pair_rules_ctes(f"{p}tx", p, support, confidence))


def _filled(p: str, gen: str) -> str:
    return (f"SELECT coalesce(s.StockCode, g.StockCode) AS StockCode, {_merge_expr('s.recs', 'g.recs')} AS recs "
            f"FROM {p}fb s FULL OUTER JOIN {gen} g ON s.StockCode = g.StockCode")


def _jaccard(v1: str, v2: str) -> str:
    return (f"CASE WHEN len(list_distinct({v1})) = 0 OR len(list_distinct({v2})) = 0 THEN 0.0 "
            f"ELSE CAST(len(list_intersect({v1}, {v2})) AS DOUBLE) / "
            f"len(list_distinct(list_concat({v1}, {v2}))) END")


def _gen_vs_segments() -> str:
    return f"""WITH tx AS ({tx_sql()}),
  {segment_ctes('tx')},
  {pair_rules_ctes('tx', 'g_', SEGMENT_SUPPORT, SEGMENT_CONFIDENCE)},
  {_segment_recs_ctes('tx', 'seg', 's1_', '1')},
  {_segment_recs_ctes('tx', 'seg', 's2_', '2')},
  f1r AS ({_filled('s1_', 'g_fb')}),
  f2r AS ({_filled('s2_', 'g_fb')}),
  segrecs AS (SELECT '1' AS segment, StockCode, recs FROM f1r UNION ALL SELECT '2', StockCode, recs FROM f2r),
  cmp AS (SELECT b.segment, g.StockCode AS KEY,
                 {_jaccard("string_split(g.recs, ',')", "string_split(b.recs, ',')")} AS jaccard_similarity
          FROM g_fb g JOIN segrecs b ON g.StockCode = b.StockCode)"""


def build() -> dict[str, str]:
    raw = f"raw AS ({raw_sql()})"
    tx = f"tx AS ({tx_sql()})"
    q: dict[str, str] = {}
    q["clean_transactions"] = f"WITH {raw} {clean_sql('raw')}"
    q["delimited_round_trip"] = q["clean_transactions"]
    q["read_delimited_strings"] = f"""WITH {raw}, ct AS ({clean_sql('raw')})
    SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS VARCHAR) AS Quantity, InvoiceDate,
           CAST(UnitPrice AS VARCHAR) AS UnitPrice, CustomerID, Country FROM ct"""
    q["single_file"] = (f"WITH {tx}, {segment_ctes('tx')} SELECT segment, count(*) AS noOfCustomers, "
                        f"CAST(1 AS BIGINT) AS n_files FROM seg GROUP BY segment")
    q["load_products"] = f"""WITH {raw}, ld AS ({loadable_sql('raw')})
    SELECT StockCode, max({{'ts': ts, 'd': Description}}).d AS Description,
           max({{'ts': ts, 'p': UnitPrice}}).p AS UnitPrice
    FROM ld GROUP BY StockCode"""
    q["load_customers"] = f"""WITH {raw}, ld AS ({loadable_sql('raw')})
    SELECT DISTINCT CustomerID, 'null' AS segment FROM ld"""
    q["purchase_features"] = f"""WITH {tx}, {segment_ctes('tx')}
    SELECT InvoiceNo, CAST(InvoiceDate AS VARCHAR) AS InvoiceDate, CustomerID, Country,
           round(pricePerPurchase, 6) AS pricePerPurchase, productsPerPurchase, quantityPerPurchase FROM pp"""
    feats = ["purchasesPerCustomer", "avgPricePerPurchasePerCustomer",
             "avgProductsPerPurchasePerCustomer", "avgQuantityPerPurchasePerCustomer"]
    exact = (feats[0], feats[2], feats[3])
    cols = ", ".join((f"scaled_{f}" if f in exact else f"round(scaled_{f}, 6) AS scaled_{f}") + ", "
                     + (f if f in exact else f"round({f}, 6) AS {f}") for f in feats)
    q["customer_features"] = f"WITH {tx}, {segment_ctes('tx')} SELECT CustomerID, {cols} FROM sc"
    q["customer_similarity"] = (f"WITH {tx}, {segment_ctes('tx')} "
                                f"SELECT CustomerID, round(similarity, 6) AS similarity FROM sim")
    q["similarity_summary"] = (f"WITH {tx}, {segment_ctes('tx')} SELECT round(max(similarity), 6) AS max_similarity, "
                               f"round(min(similarity), 6) AS min_similarity, "
                               f"round(avg(similarity), 6) AS avg_similarity FROM sim")
    q["customer_segments"] = f"WITH {tx}, {segment_ctes('tx')} SELECT CustomerID, segment FROM seg"
    q["segment_stats"] = (f"WITH {tx}, {segment_ctes('tx')} "
                          f"SELECT segment, count(*) AS noOfCustomers FROM seg GROUP BY segment")
    q["update_segments"] = f"""WITH {raw}, ld AS ({loadable_sql('raw')}),
      cust AS (SELECT DISTINCT CustomerID, 'null' AS segment FROM ld),
      ct AS ({clean_sql('raw')}),
      {segment_ctes('ct')}
    SELECT DISTINCT c.CustomerID, coalesce(s.segment, c.segment) AS segment
    FROM cust c LEFT JOIN seg s ON c.CustomerID = s.CustomerID"""
    q["replace_own_input"] = q["update_segments"]
    features = " UNION ALL ".join(
        f"SELECT 'features' AS output, CustomerID AS key, round(CAST({p}{c} AS DOUBLE), 6) AS num, '{p}{c}' AS txt FROM sc"
        for c in CUSTOMER_FEATURES for p in (SCALED_PREFIX, ""))
    q["segmentation_job"] = f"""WITH {raw}, ld AS ({loadable_sql('raw')}),
      cust AS (SELECT DISTINCT CustomerID, 'null' AS segment FROM ld),
      ct AS ({clean_sql('raw')}),
      {segment_ctes('ct')}
    {features}
    UNION ALL SELECT 'similarity', CustomerID, round(similarity, 6), NULL FROM sim
    UNION ALL SELECT 'stats', segment, CAST(count(*) AS DOUBLE), NULL FROM seg GROUP BY segment
    UNION ALL SELECT 'segments', CustomerID, NULL, segment FROM seg
    UNION ALL SELECT DISTINCT 'customers', c.CustomerID, CAST(NULL AS DOUBLE), coalesce(s.segment, c.segment)
      FROM cust c LEFT JOIN seg s ON c.CustomerID = s.CustomerID"""
    q["segment_transactions"] = f"""WITH {tx}, {segment_ctes('tx')}
    SELECT DISTINCT t.InvoiceNo, t.StockCode, t.Description, t.Quantity, t.UnitPrice, t.CustomerID,
           CAST(t.InvoiceDate AS VARCHAR) AS InvoiceDate, t.Country, s.segment
    FROM tx t JOIN seg s ON t.CustomerID = s.CustomerID WHERE s.segment = '1'"""
    q["baskets"] = f"""WITH {tx}
    SELECT InvoiceNo, CAST(InvoiceDate AS VARCHAR) AS InvoiceDate, CustomerID, Country,
           array_to_string(list_sort(list_distinct(list(StockCode))), ',') AS items
    FROM tx GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country"""
    tx_type = f"tx AS ({tx_sql('p_type')})"
    q["frequent_itemsets"] = (f"WITH RECURSIVE {tx_type}, {itemset_ctes('tx', TYPE_SUPPORT, TYPE_CONFIDENCE)} "
                              f"SELECT array_to_string(items, ',') AS items, freq FROM fi")
    q["association_rules"] = (f"WITH RECURSIVE {tx_type}, {itemset_ctes('tx', TYPE_SUPPORT, TYPE_CONFIDENCE)} "
                              f"SELECT array_to_string(antecedent, ',') AS antecedent, consequent, "
                              f"confidence, lift, support FROM ru")
    q["recommend_for_baskets"] = f"""WITH RECURSIVE {tx_type}, {itemset_ctes('tx')},
      m AS (SELECT b.InvoiceNo, b.InvoiceDate, b.CustomerID, b.Country, r.consequent, max(r.confidence) AS conf
            FROM bk b JOIN ru r ON list_has_all(b.items, r.antecedent)
                 AND NOT list_contains(b.items, r.consequent)
            GROUP BY b.InvoiceNo, b.InvoiceDate, b.CustomerID, b.Country, r.consequent),
      pr AS (SELECT InvoiceNo, InvoiceDate, CustomerID, Country,
                    string_agg(consequent, ',' ORDER BY conf DESC, consequent) AS recs
             FROM m GROUP BY InvoiceNo, InvoiceDate, CustomerID, Country)
    SELECT b.InvoiceNo, CAST(b.InvoiceDate AS VARCHAR) AS InvoiceDate, b.CustomerID, b.Country,
           array_to_string(b.items, ',') AS items, pr.recs
    FROM bk b JOIN pr ON b.InvoiceNo = pr.InvoiceNo AND b.InvoiceDate = pr.InvoiceDate
         AND b.CustomerID = pr.CustomerID AND b.Country = pr.Country"""
    q["frequently_bought"] = f"WITH {tx}, {pair_rules_ctes('tx', 'g_')} SELECT StockCode, recs FROM g_fb"
    q["frequently_bought_segment"] = f"""WITH {tx}, {segment_ctes('tx')},
      {_segment_recs_ctes('tx', 'seg', 's1_', '1')},
      {_segment_recs_ctes('tx', 'seg', 's2_', '2')}
    SELECT '1' AS segment, StockCode, recs FROM s1_fb UNION ALL SELECT '2', StockCode, recs FROM s2_fb"""
    q["merge_recommendations"] = f"""WITH {tx}, {segment_ctes('tx')},
      {pair_rules_ctes('tx', 'g_', SEGMENT_SUPPORT, SEGMENT_CONFIDENCE)},
      {_segment_recs_ctes('tx', 'seg', 's1_', '1')},
      {_segment_recs_ctes('tx', 'seg', 's2_', '2')}
    SELECT '1' AS segment, * FROM ({_filled('s1_', 'g_fb')}) a
    UNION ALL SELECT '2' AS segment, * FROM ({_filled('s2_', 'g_fb')}) b"""
    q["segment_target"] = f"""WITH {tx}, {segment_ctes('tx')},
      {pair_rules_ctes('tx', 'g_', SEGMENT_SUPPORT, SEGMENT_CONFIDENCE)},
      {_segment_recs_ctes('tx', 'seg', 's1_', '1')},
      {_segment_recs_ctes('tx', 'seg', 's2_', '2')}
    SELECT 'gen' AS segment, StockCode, recs FROM g_fb
    UNION ALL SELECT '1' AS segment, * FROM ({_filled('s1_', 'g_fb')}) a
    UNION ALL SELECT '2' AS segment, * FROM ({_filled('s2_', 'g_fb')}) b"""
    q["jaccard_compare"] = (_gen_vs_segments() + " SELECT segment, KEY, round(jaccard_similarity, 6) "
                            "AS jaccard_similarity, round(1.0 - jaccard_similarity, 6) AS jaccard_distance FROM cmp")
    q["jaccard_summary"] = (_gen_vs_segments() + " SELECT segment, round(avg(1.0 - jaccard_similarity), 6) "
                            "AS jaccard_distance, round(avg(jaccard_similarity), 6) AS jaccard_similarity "
                            "FROM cmp GROUP BY segment")
    cent = """WITH ev AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
      ex AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM ev),
      el AS (SELECT label, i, avg(x) AS m FROM ex GROUP BY label, i),
      ce AS (SELECT label, list(m ORDER BY i) AS c FROM el GROUP BY label),
      d AS (SELECT ev.vec_id, ev.label, ev.v, ce.c,
                   list_sum(list_transform(list_zip(ev.v[1:least(len(ev.v), len(ce.c))],
                                                    ce.c[1:least(len(ev.v), len(ce.c))]),
                                           lambda p: (p[2] - p[1]) * (p[2] - p[1]))) AS sq
            FROM ev JOIN ce ON ev.label = ce.label)"""
    q["embedding_euclidean"] = cent + " SELECT vec_id, label, round(sqrt(sq), 6) AS distance FROM d"
    q["embedding_vector_euclidean"] = q["embedding_euclidean"]
    q["embedding_msd"] = (cent + " SELECT vec_id, label, round(sq / len(v), 6) AS msd, "
                          "round(1.0 / (sq / len(v) + 1.0), 6) AS ms_similarity FROM d")
    q["pipeline_recommendations"] = f"""WITH {raw}, ld AS ({loadable_sql('raw')}),
      cust AS (SELECT DISTINCT CustomerID, 'null' AS segment FROM ld),
      ct AS ({clean_sql('raw')}),
      {segment_ctes('ct')},
      upd AS (SELECT DISTINCT c.CustomerID, coalesce(s.segment, c.segment) AS segment
              FROM cust c LEFT JOIN seg s ON c.CustomerID = s.CustomerID),
      {pair_rules_ctes('ct', 'g_', RAW_SUPPORT, RAW_CONFIDENCE)},
      {_segment_recs_ctes('ct', 'upd', 's1_', '1', RAW_SUPPORT, RAW_CONFIDENCE)},
      {_segment_recs_ctes('ct', 'upd', 's2_', '2', RAW_SUPPORT, RAW_CONFIDENCE)}
    SELECT 'gen' AS segment, StockCode, recs FROM g_fb
    UNION ALL SELECT '1' AS segment, * FROM ({_filled('s1_', 'g_fb')}) a
    UNION ALL SELECT '2' AS segment, * FROM ({_filled('s2_', 'g_fb')}) b"""
    return q
