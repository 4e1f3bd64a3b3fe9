"""Document fingerprints by a homomorphic multiset hash (DataFrame functions only).

A text's paragraphs (its lines) are cut at clause ends into segments, which keep their closing marks
but not the white space around them.  Every segment hashes to a wide vector; a fingerprint is the sum
of the vectors of all segments, each coordinate modulo a power of two, and counts of the text's
white space.  So it does not depend on their order, equal texts have equal fingerprints, and a
paragraph is inserted or deleted by adding or subtracting its vector (``add`` and ``subtract``)
without the text.

Coordinates:

* the numbers of shingles and of segments;
* EXACT_HASHES 64-bit hashes of the whole segment, each as two words modulo 2**32, for equality;
* for likeness, counters: how many shingles have each bit of SKETCH_HASHES 64-bit hashes, two counters
  of 32 bits in one number.  A text has less than 2**31 bytes, so no counter of a text overflows.
  A shingle is three adjoining tokens of a segment (all of them, if fewer); tokens are its words, or
  for words over WORD characters their runs of CHARS characters from each character on, so that texts
  in scripts without spaces and unbroken data have local shingles too;
* line feeds, spaces and other white space.

A counter against half the number of shingles is a random +1/-1 sum, so differences of counters
estimate the size of the difference of two multisets; with ``E(x)`` such an estimate of a sum of
squares, the likeness of A and B is 1 - E(A - B) / (E(A) + E(B)), cut to 0..1: 1 for equal, about
the shared part of all shingles else.

``edit_likeness`` makes both fingerprints from the segments that they share, those of the text's own
tail and those of the next document's head; only the paragraph at the seam is cut anew.  The next document is found on ids and lengths alone; then each text is shuffled
once, and the head that its predecessor takes over once more.

Results for odd input: see ``common.keyed`` (null text: empty; null id sorts first; a
repeated id is one document).  An empty text has the zero fingerprint; two of these have
likeness 1, an empty and another text 0.  A table of one document follows itself; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import keyed, public_id, written

EXACT_HASHES = 4   # 64 bits each: two coordinates
SKETCH_HASHES = 2  # 64 bits each: 32 coordinates of two counters
HALF = 32
WORD, CHARS = 24, 8
LOW = (1 << HALF) - 1
BOTH_LANES = 1 | 1 << HALF
N_EXACT, N_PACKED = 2 * EXACT_HASHES, HALF * SKETCH_HASHES
N_SPACE = 3        # line feeds, spaces, other white space
# White space but line feeds, within Latin-1 (as a class of a regular expression, which one table decides) and beyond.
LATIN = r" \t\x0b-\r\x1c-\x1f\x85\xa0"
BEYOND = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = (" \t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
          + "\u2028\u2029\u202f\u205f\u3000")
MARKS = ".!?,;:|"
SEGMENT = rf"[^\n{MARKS}]++[{MARKS}]*+|[{MARKS}]++"
RUNS = rf"(?s)(?=(.{{1,{CHARS}}}))."   # from each character on
MAX_RANGES = 4096
KEPT, OWN, EDITED, FACTS = range(4)  # parts: of both texts, of the own, of the edited one; what is known of the row


def _coordinates() -> list[Column]:
    """Of a row with a shingle's hash ``_h``, and at a segment's first shingle with its hashes ``_exact``."""
    zero = F.lit(0).cast("long")
    first = F.col("_exact").isNotNull() & (F.col("_pos") == 0)
    exact = [F.when(first, F.get("_exact", F.lit(i))).otherwise(zero) for i in range(EXACT_HASHES)]
    out = [F.when(c, F.lit(1).cast("long")).otherwise(zero) for c in (F.col("_h").isNotNull(), first)]
    for h in exact:
        out += [h.bitwiseAND(LOW), F.shiftrightunsigned(h, HALF)]
    sketch = [F.col("_h"), *(F.xxhash64(F.lit(i), F.col("_h")) for i in range(1, SKETCH_HASHES))]
    for h in sketch:
        h = F.when(F.col("_h").isNotNull(), h).otherwise(zero)
        out += [F.shiftrightunsigned(h, j).bitwiseAND(BOTH_LANES) for j in range(HALF)]
    return out


# Coordinates modulo 2**32 but for the counters, which are modulo 2**64 as longs are.
_MASKS = [LOW] * (2 + N_EXACT) + [-1] * N_PACKED + [LOW] * N_SPACE


def _masks() -> Column:
    return F.array(*[F.lit(m).cast("long") for m in _MASKS])


def _spaces(text: Column) -> Column:
    size = F.char_length(text)
    counts = [size - F.char_length(F.replace(text, F.lit(c))) for c in ("\n", " ")]
    others = F.regexp_count(text, F.lit(f"[{LATIN[1:]}]")) + F.when(
        text.rlike("[\u1680-\u3000]"), F.regexp_count(text, F.lit(f"[{BEYOND}]"))).otherwise(0)
    return F.array(*[c.cast("long") for c in (*counts, others)])


def _tokens(segment: Column) -> Column:
    """Words, those over WORD characters as their runs of characters."""
    return F.flatten(F.transform(F.split(segment, f"[{LATIN}]++"), lambda w: F.when(
        F.char_length(w) > WORD, F.regexp_extract_all(w, F.lit(RUNS), F.lit(1))).otherwise(F.array(w))))


def _sums(lines: DataFrame, keys: list[str], line: str) -> DataFrame:
    """``keys`` and ``_sum`` (array of longs, without white space) over the segments of the column ``line``."""
    rows = lines.select(*keys, F.explode_outer(F.regexp_extract_all(F.col(line), F.lit(SEGMENT), F.lit(0))).alias("_s"))
    segment = F.btrim(F.col("_s"), F.lit(BLANKS))
    rows = rows.select(*keys, F.when(F.length(segment) > 0, segment).alias("_s"))
    rows = rows.select(*keys, F.when(F.col("_s").isNotNull(), F.array(
        *[F.xxhash64(F.lit(-1 - i), F.col("_s")) for i in range(EXACT_HASHES)])).alias("_exact"),
        # As a row of its own the list is made once; within the next step it would be made for each token.
        F.explode_outer(F.array(_tokens(F.col("_s")))).alias("_t"))
    last = F.greatest(F.size("_t") - 2, F.lit(1))
    hashes = F.transform(F.slice(F.col("_t"), F.lit(1), last),
                         lambda t, i: F.xxhash64(t, F.get(F.col("_t"), i + 1), F.get(F.col("_t"), i + 2)))
    rows = rows.select(*keys, "_exact", F.posexplode_outer(hashes).alias("_pos", "_h"))
    coords = _coordinates()
    sums = rows.groupBy(*keys).agg(*[F.sum(c).alias(f"_c{i}") for i, c in enumerate(coords)])
    return sums.select(*keys, F.array(*[F.col(f"_c{i}").bitwiseAND(F.lit(_MASKS[i]).cast("long")) for i in range(len(coords))]).alias("_sum"))


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``vector`` (array of longs) of each row; rows with equal keys are summed up."""
    spaces = _spaces(F.col(text))
    lines = texts.select(*keys, spaces.alias("_s"), F.posexplode(F.split(F.col(text), "\n")).alias("_line", "_part"))
    own = [F.when(F.col("_line") == 0, F.get("_s", F.lit(i))).otherwise(0) for i in range(N_SPACE)]
    counts = lines.groupBy(*keys).agg(*[F.sum(c).alias(f"_s{i}") for i, c in enumerate(own)])
    counts = counts.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.array(*[f"_s{i}" for i in range(N_SPACE)]).alias("_s"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys)]
    sums = _sums(lines, keys, "_part")
    on = same[0]
    for c in same[1:]:
        on = on & c
    return sums.join(counts, on).select(*keys, F.concat("_sum", "_s").alias("vector"))


def add(a: Column, b: Column) -> Column:
    """The fingerprint vector of two texts' segments together (counters wrap, and do not raise)."""
    return F.zip_with(_plus(a, b), _masks(), lambda x, m: x.bitwiseAND(m))


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint vector of a's segments without b's."""
    return F.zip_with(_plus(a, F.transform(b, lambda x: F.try_subtract(F.lit(0).cast("long"), x))), _masks(), lambda x, m: x.bitwiseAND(m))


def _plus(a: Column, b: Column) -> Column:
    """Sums modulo 2**64 of longs: by halves, as sums over the range raise."""
    def total(x: Column, y: Column) -> Column:
        low = x.bitwiseAND(LOW) + y.bitwiseAND(LOW)
        high = F.shiftrightunsigned(x, HALF) + F.shiftrightunsigned(y, HALF) + F.shiftrightunsigned(low, HALF)
        return F.shiftleft(high.bitwiseAND(LOW), HALF).bitwiseOR(low.bitwiseAND(LOW))
    return F.zip_with(a, b, total)


def as_text(vector: Column) -> Column:
    """The vector as lower-case hex digits of fixed width."""
    width = [8] * (2 + N_EXACT) + [16] * N_PACKED + [8] * N_SPACE
    padded = F.zip_with(vector, F.array(*[F.lit(w) for w in width]),
                        lambda v, w: F.call_function("lpad", F.lower(F.hex(v)), w, F.lit("0")))
    return F.array_join(padded, "")


def sketch(vector: Column) -> Column:
    """The packed counters of a vector."""
    return F.slice(vector, 3 + N_EXACT, N_PACKED)


def _difference(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """Estimated sum of squares of the difference of two multisets, by packed counters and numbers of shingles.

    A counter's random sum is the number without its bit less that with it, n - 2c.  Lambdas see columns and
    literals only: an expression in one would be evaluated for each element.
    """
    delta = (na - nb).cast("double")
    apart = F.zip_with(a, b, lambda x, y: F.struct((x.bitwiseAND(LOW) - y.bitwiseAND(LOW)).alias("l"),
                                                   (F.shiftrightunsigned(x, HALF) - F.shiftrightunsigned(y, HALF)).alias("h")))
    # Sum of (delta - 2d)**2 over the counters' differences d, by the sums of d and of its square.
    sums = F.aggregate(apart, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("s")), lambda t, x: F.struct(
        (t.d + x.l + x.h).alias("d"), (t.s + x.l.cast("double") * x.l + x.h.cast("double") * x.h).alias("s")))
    return F.transform(F.array(sums), lambda t: 2 * N_PACKED * delta * delta - 4 * delta * t.d + 4 * t.s)[0]


def sketch_likeness(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """Likeness by packed counters and numbers of shingles."""
    none = F.array(*[F.lit(0).cast("long")] * N_PACKED)
    zero = F.lit(0).cast("long")
    parts = F.array(_difference(a, b, na, nb), _difference(a, none, na, zero), _difference(b, none, nb, zero))
    of = F.transform(F.array(parts), lambda p: F.when(p[1] + p[2] == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - p[0] / (p[1] + p[2])))))[0]
    return F.when((na == nb) & (a == b), F.lit(1.0)).otherwise(of)


def likeness(a: Column, b: Column) -> Column:
    """The estimated likeness of two texts, 0 to 1, from their fingerprint vectors."""
    return F.when(a == b, F.lit(1.0)).otherwise(sketch_likeness(sketch(a), sketch(b), F.element_at(a, 1), F.element_at(b, 1)))


def with_next(rows: DataFrame, ranges: int) -> DataFrame:
    """``rows`` (_id, _size) with ``_next_id`` in the order of ids, cyclic.

    Ids are cut into ranges at quantiles (an aggregate of bounded size); each range is a
    partition sorted by id, with the first row of the following range added at its end, so
    no task sees more than a range of ids.
    """
    cuts = [k / ranges for k in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("_id", cuts, 10000)).first()[0] if cuts else []
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds or []))])
    rows = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col("_id"))))
    heads = sorted((r[0], r[1]) for r in rows.groupBy("_range").agg(F.min("_id")).collect())  # <= ranges rows
    before = {first: heads[k - 1][0] for k, (_, first) in enumerate(heads)}
    all_rows = rows.withColumn("_added", F.lit(0))
    if before:
        place = F.create_map(*[F.lit(x).cast("long") if i % 2 == 0 else F.lit(x) for kv in before.items() for i, x in enumerate(kv)])
        ends = rows.where(F.col("_id").isin(list(before)))
        all_rows = all_rows.unionByName(ends.withColumn("_range", place[F.col("_id")]).withColumn("_added", F.lit(1)))
    w = Window.partitionBy("_range").orderBy("_added", "_id")
    return all_rows.withColumn("_next_id", F.lead("_id").over(w)).where("_added = 0").drop("_range", "_added")


def _lines(text: Column, part: int) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.struct(F.lit(part).alias("part"), x.alias("text")))


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text has its last floor(n/2) code points replaced by the first as many (or
    all) of the next document's, in ascending order of ids, after the last the first.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    sizes = written(spark, rows.select("_id", F.char_length("_text").alias("_size")), "sizes")
    ranges = min(MAX_RANGES, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = written(spark, with_next(sizes, ranges), "order")
    # The head of each text, as long as its predecessor's half, goes to its predecessor.
    taken = order.select(F.col("_next_id").alias("_id"), F.col("_id").alias("_before"), F.floor(F.col("_size") / 2).cast("int").alias("_half"))
    heads = rows.join(taken, "_id").select(F.col("_before").alias("_id"), F.substring("_text", F.lit(1), F.col("_half")).alias("_head"))
    size = F.char_length("_text")
    both = rows.join(order.select("_id", "_next_id"), "_id").join(heads, "_id").select(
        "_id", "_next_id", "_text", "_head", (size - F.floor(size / 2)).cast("int").alias("_n")).select(
        "*", F.substring("_text", F.lit(1), F.col("_n")).alias("_kept"), F.substring("_text", F.col("_n") + 1, size).alias("_tail"))
    cut = lambda c: F.substring_index(c, "\n", 1)
    seam = F.substring_index("_kept", "\n", -1)
    rest = lambda c: F.substring(F.col(c), F.char_length(cut(c)) + 1, F.char_length(c))
    kept = F.substring(F.col("_kept"), F.lit(1), (F.col("_n") - F.char_length(seam)).cast("int"))
    edited = F.concat("_kept", "_head")
    facts = F.struct(F.col("_next_id").alias("next"), size.cast("long").alias("n_chars"),
                     F.sha2(F.encode(edited, "UTF-8"), 256).alias("sha"), _spaces(F.col("_text")).alias("own"), _spaces(edited).alias("edited"))
    parts = F.concat(
        _lines(kept, KEPT), _lines(F.concat(seam, cut("_tail")), OWN), _lines(rest("_tail"), OWN),
        _lines(F.concat(seam, cut("_head")), EDITED), _lines(rest("_head"), EDITED),
        F.array(F.struct(F.lit(FACTS).alias("part"), F.lit("").alias("text"))))
    lines = both.select("_id", facts.alias("_facts"), F.explode(parts).alias("_l")).select(
        "_id", F.col("_l.part").alias("_part"), F.when(F.col("_l.part") == FACTS, F.col("_facts")).alias("_facts"), F.col("_l.text").alias("_line"))
    lines = lines.where((F.col("_part") == FACTS) | (F.length("_line") > 0))
    sums = _sums(lines, ["_id", "_part", "_facts"], "_line")
    none = F.array(*[F.lit(0).cast("long")] * (2 + N_EXACT + N_PACKED))
    by_part = sums.groupBy("_id").agg(F.collect_list(F.struct("_part", "_facts", "_sum")).alias("x"))  # four at most
    of = lambda p: F.coalesce(F.get(F.filter("x", lambda r: r._part == p), F.lit(0))._sum, none)
    known = F.get(F.filter("x", lambda r: r._part == FACTS), F.lit(0))._facts
    own, other = F.zip_with(of(KEPT), of(OWN), lambda x, y: x + y), F.zip_with(of(KEPT), of(EDITED), lambda x, y: x + y)
    made = written(spark, by_part.select("_id", known.alias("f"), own.alias("a"), other.alias("b")).select(
        "_id", F.col("f.next").alias("_next_id"), F.col("f.n_chars").alias("n_chars"), F.col("f.sha").alias("edited_sha256"),
        _masked(F.concat("a", "f.own")).alias("own"), _masked(F.concat("b", "f.edited")).alias("edited")), "fingerprints")
    after = made.select(F.col("_id").alias("_next_id"), sketch(F.col("own")).alias("_after"), F.element_at("own", 1).alias("_n_after"))
    return made.join(after, "_next_id").select(
        public_id(), "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        sketch_likeness(sketch(F.col("own")), F.col("_after"), F.element_at("own", 1), F.col("_n_after")).alias("near_next"))


def _masked(vector: Column) -> Column:
    return F.zip_with(vector, _masks(), lambda x, m: x.bitwiseAND(m))
