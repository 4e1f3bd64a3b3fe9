"""Secret scan with a random forest that removes false positives (DataFrame functions and
Spark ML only).

Candidates are runs of key-like characters of at least MIN_LENGTH with a digit or both
cases within a text's words, and whole values: what is assigned (``=`` or ``:``) in a word that
begins with a name, or follows a key word and such a sign, of any length, without
opening and closing quotes and brackets.  Each has features of its shape (length, character classes and the transitions
between them, distinct characters), the share of it that a dictionary's words cover, alone or run together, the
path the text comes from, and its neighbouring words.  A random forest, trained on labelled
findings, gives the probability that a candidate is a secret.

Labelled findings are given by the caller.  ``planted_findings`` makes a set from a bounded
number of documents: values of known kind, secrets and none, are put between words of a document, and what
the candidates find there has the kind's label, whatever it looks like (secrets without key words,
harmless values behind key words).  ``label_findings`` labels candidates by rules of high precision
(fixed formats, assignments to a key word; addresses, numbers) where nothing better is known; it is used if
no findings are given.  The forest is trained on at most ``max_labelled`` findings,
those with the smallest hashes; if all have one label, that is every candidate's score.

Texts are cut, matched and measured in time linear in their length but for a small term (a candidate's place
is added up from blocks of BLOCK words): patterns are anchored or possessive, and lists that
several steps use are made once.

Results for odd input: a null or empty text has no candidates; a null path counts as empty;
a null id stays null; repeated rows give repeated findings; an empty table gives no rows;
without labelled findings every score is null and nothing is a secret.  Only the named
columns are read.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import written

MIN_LENGTH = 12
MAX_LABELLED = 20_000
DEFAULT_DICTIONARY = "/opt/tokenizers/word_bpe_49k.json"
DICTIONARY_LIMIT = 200_000
COVERING, LONGEST = 4, 14  # letters of the dictionary's words that count
MAX_PLANTED = 800          # documents that get planted findings, one of each kind
RUN = r"[A-Za-z0-9+/=_.@\-]{%d,}" % MIN_LENGTH
# Words that name a secret, and places of made-up ones.
KEY_WORDS = r"(?i)(passw(or)?d|pwd|token|secret|api_?key|access_?key|auth|bearer|credential)"
SAMPLE_PATH = r"(?i)(test|example|sample|mock|fixture|doc)"
# The stems of KEY_WORDS in lower case: a text without any has no key word.
KEY_STEMS = ["passw", "pwd", "token", "secret", "apikey", "api_key", "accesskey", "access_key", "auth", "bearer", "credential"]
# name=value in a word, at its first sign; a sign alone or at a word's end.
ASSIGNED = r"^([^=:]*+)(?::=|=>|=|:(?!//))(.+)$"
SIGN = r"(?:=|:|=>|:=)$"
CLOSED_NAME = "\"'])"     # what may stand between a name and its sign
OPENING, CLOSING, QUOTES = "\"'`({[<", ")}]>,;.", "\"'`"
SPACES = " \t\n\x0b\f\r"
BLOCK = 1024
FEATURES = ["f_length", "f_lower", "f_upper", "f_digit", "f_mark", "f_hex", "f_lower_digit", "f_digit_lower",
            "f_upper_digit", "f_digit_upper", "f_case", "f_distinct", "f_coverage", "f_path_depth", "f_path_sample",
            "f_path_digits", "f_key_word", "f_assigned", "f_quoted", "f_before", "f_after", "f_at", "f_dots"]


def _name(before_sign: Column) -> Column:
    """The name that ends a string, but for closing quotes and brackets: letters, digits and ``_.-``."""
    return F.reverse(F.regexp_extract(F.reverse(F.rtrim(before_sign, F.lit(CLOSED_NAME))), r"^([\w.\-]*+)", 1))


def _ends_with_key(word: Column) -> Column:
    """The word ends with a name that holds a key word, and perhaps a sign."""
    return word.rlike(KEY_WORDS) & _name(F.regexp_replace(word, SIGN, "")).rlike(KEY_WORDS)


def _assigned(word: Column) -> Column:
    """What is assigned at the first sign of a word that has a name with a letter before it, or an empty string."""
    named = F.reverse(F.rtrim(F.regexp_extract(word, ASSIGNED, 1), F.lit(CLOSED_NAME))).rlike(r"^[0-9_.\-]*+[A-Za-z]")
    return F.when((word.contains("=") | word.contains(":")) & named, F.regexp_extract(word, ASSIGNED, 2)).otherwise(F.lit(""))


def _once(expression: Column) -> Column:
    """A row's value as a row of its own, so that lambdas after it see a column and do not evaluate it for each element."""
    return F.explode(F.array(expression))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, path, start, candidate and the words around it."""
    mixed = lambda c: c.rlike("[0-9]") | (c.rlike("[a-z]") & c.rlike("[A-Z]"))
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    lower = F.lower("_text")
    has_key = F.lit(False)
    for stem in KEY_STEMS:
        has_key = has_key | lower.contains(stem)
    # Words with the white space before them.
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"),
                        F.col(text_col).cast("string").alias("_text"))
            .where(F.length("_text") > 0)
            .select("doc_id", "path", has_key.alias("_has_key"), _once(F.regexp_extract_all("_text", F.lit(r"\s*+\S++"), F.lit(0))).alias("_w")))
    w = F.col("_w")
    size = F.aggregate
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(w) / BLOCK).cast("int")), lambda b: size(
        F.slice(w, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("long"), lambda n, x: n + F.char_length(x)))
    keys = F.when(F.col("_has_key"), F.transform(w, _ends_with_key))
    rows = rows.select("doc_id", "path", "_w", _once(F.struct(blocks.alias("sizes"), keys.alias("keys"))).alias("_d"))
    rows = rows.select("doc_id", "path", "_w", F.col("_d.keys").alias("_keys"), _once(F.transform(
        F.col("_d.sizes"), lambda _, b: size(F.slice(F.col("_d.sizes"), F.lit(1), b), F.lit(0).cast("long"), lambda n, x: n + x))).alias("_starts"))

    is_key = lambda i: F.coalesce(F.get(F.col("_keys"), i), F.lit(False))
    word_at = lambda i: F.coalesce(F.ltrim(F.get(w, i), F.lit(SPACES)), F.lit(""))

    def after_key(i: Column) -> Column:
        """The word before is a key word, with or without a sign, or a sign after a key word."""
        return F.when(F.col("_keys").isNotNull(), is_key(i - 1) | (is_key(i - 2) & word_at(i - 1).rlike("^" + SIGN))).otherwise(F.lit(False))

    found = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda x: (
        (F.length(x.w) >= MIN_LENGTH) & x.w.rlike(RUN) & mixed(x.w)) | (_assigned(F.ltrim(x.w, F.lit(SPACES))) != "") | after_key(x.i))

    def start(i: Column) -> Column:
        """The place of word i: its block's start, the words before it there, and its own white space."""
        first = F.floor(i / BLOCK).cast("int")
        return size(F.slice(w, first * BLOCK + 1, F.pmod(i, F.lit(BLOCK))), F.get(F.col("_starts"), first),
                    lambda n, x: n + F.char_length(x))
    found = F.transform(found, lambda x: F.struct(
        start(x.i).alias("at"), x.w.alias("w"), after_key(x.i).alias("after_key"), word_at(x.i - 2).alias("before2"),
        word_at(x.i - 1).alias("before"), word_at(x.i + 1).alias("after")))
    rows = rows.select("doc_id", "path", F.explode(found).alias("x")).select(
        "doc_id", "path", F.ltrim(F.col("x.w"), F.lit(SPACES)).alias("word"), F.col("x.after_key").alias("_after_key"),
        (F.col("x.at") + F.char_length("x.w")).alias("_end"), "x.before2", "x.before", "x.after")
    rows = rows.withColumn("_given", _assigned(F.col("word")))
    # After a key word the word is the value, unless it names a key word itself.
    named = _name(F.regexp_extract("word", ASSIGNED, 1)).rlike(KEY_WORDS)
    whole = (F.when((F.col("_given") != "") & (named | ~F.col("_after_key")), F.col("_given"))
             .when(F.col("_after_key"), F.col("word")).otherwise(F.lit("")))
    value = F.rtrim(F.rtrim(F.ltrim(whole, F.lit(OPENING)), F.lit(CLOSING)), F.lit(QUOTES))
    rows = rows.withColumn("_value", value)
    # In key=value the value is the candidate, unless nothing follows the sign; a run within the value is the value's.
    runs = F.filter(F.regexp_extract_all("word", F.lit(f"({RUN})"), F.lit(1)), mixed)
    runs = F.transform(runs, lambda r: F.coalesce(F.nullif(F.regexp_extract(r, r"^[A-Za-z_.\-]+=(.{8,})$", 1), F.lit("")), r))
    own = F.filter(runs, lambda r: mixed(r) & ~F.contains(F.col("_value"), r))
    value = F.when((F.length("_value") > 0) & ~F.col("_value").rlike("^" + SIGN), F.array("_value")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("candidate", F.explode(F.concat(value, own)))
    start = F.col("_end") - F.char_length("word") + F.instr("word", F.col("candidate")) - 1
    return rows.select("doc_id", "path", start.cast("long").alias("start"), "candidate", "word", "before2", "before", "after")


def dictionary(spark: SparkSession, path: str = DEFAULT_DICTIONARY) -> DataFrame:
    """Whole words of three letters and more of a public vocabulary file, at most DICTIONARY_LIMIT."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = sorted({w.removesuffix("</w>") for w in vocab if w.endswith("</w>")})
    words = [(w,) for w in words if len(w) >= 3 and w.isascii() and w.isalpha()]
    if len(words) > DICTIONARY_LIMIT:
        raise ValueError("the dictionary is broadcast; give a smaller one")
    return spark.createDataFrame(words, "piece string")


def _count(col: str, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern)).cast("double")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``candidate`` and ``_covered``: characters of it that are in dictionary words of COVERING letters and more,
    also where words are run together."""
    letters = F.posexplode(F.regexp_extract_all(F.lower("candidate"), F.lit(rf"(?=([a-z]{{1,{LONGEST}}}))?(?s:.)"), F.lit(1)))
    places = (found.select("candidate").distinct().select("candidate", letters.alias("at", "ahead")).where(F.length("ahead") >= COVERING)
              .select("candidate", "at", F.explode(F.sequence(F.lit(COVERING), F.length("ahead"))).alias("n"), "ahead")
              .select("candidate", "at", "n", F.expr("substring(ahead, 1, n)").alias("piece")))
    longest = places.join(F.broadcast(words), "piece").groupBy("candidate", "at").agg(F.max("n").alias("n"))
    return (longest.select("candidate", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("place"))
            .groupBy("candidate").agg(F.count_distinct("place").alias("_covered")))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` (a written table) with a numeric column for each of FEATURES."""
    pieces = coverage(found, words)
    length = F.length("candidate").cast("double")
    around = F.concat_ws(" ", "before2", "before", "word")
    flag = lambda c: c.cast("double")
    return (found.join(pieces, "candidate", "left").withColumns({
        "f_length": length, "f_lower": _count("candidate", "[a-z]") / length, "f_upper": _count("candidate", "[A-Z]") / length,
        "f_digit": _count("candidate", "[0-9]") / length, "f_mark": _count("candidate", "[^A-Za-z0-9]") / length,
        "f_hex": _count("candidate", "[0-9a-f]") / length, "f_lower_digit": _count("candidate", "[a-z](?=[0-9])") / length,
        "f_digit_lower": _count("candidate", "[0-9](?=[a-z])") / length,
        "f_upper_digit": _count("candidate", "[A-Z](?=[0-9])") / length,
        "f_digit_upper": _count("candidate", "[0-9](?=[A-Z])") / length,
        "f_case": _count("candidate", "[a-z](?=[A-Z])|[A-Z](?=[a-z])") / length,
        "f_distinct": F.size(F.array_distinct(F.split("candidate", ""))) / length,
        "f_coverage": F.coalesce(F.col("_covered").cast("double"), F.lit(0.0)) / length,
        "f_path_depth": _count("path", "/"), "f_path_sample": flag(F.col("path").rlike(SAMPLE_PATH)),
        "f_path_digits": _count("path", "[0-9]"), "f_key_word": flag(around.rlike(KEY_WORDS)),
        "f_assigned": flag(F.concat("before", "word").rlike("[=:]")), "f_quoted": flag(F.col("word").rlike("[\"']")),
        "f_before": F.length("before").cast("double"), "f_after": F.length("after").cast("double"),
        "f_at": flag(F.col("candidate").contains("@")), "f_dots": _count("candidate", "[.]"),
    }).drop("_covered"))


def label_findings(found: DataFrame) -> DataFrame:
    """``found`` with ``label`` for those that a rule decides: 1 secret, 0 none, else null."""
    around = F.concat_ws(" ", "before2", "before", "word")
    c = F.col("candidate")
    no = c.rlike(r"^[^@]+@[^@]+\.[A-Za-z.\-]+$") | c.rlike(r"^[0-9.\-]+$") | c.rlike(r"^(https?|www)")
    yes = c.rlike("^AKIA[0-9A-Z]{16}$") | (around.rlike(KEY_WORDS.replace("(?i)", "(?i)\\b") + r"['\"]?\s*[=:]") & c.rlike("^[A-Za-z0-9+/_=\\-]{16,}$"))
    return found.withColumn("label", F.when(no, 0.0).when(yes, 1.0))


def _planted(h: Column, words: list[Column]) -> list[tuple[int, Column, str, str]]:
    """(label, value, what stands before it, after it) of every kind; ``h``: a digest in hex, ``words`` of the document."""
    b = F.translate(F.base64(F.unhex(h)), "=", "")
    part = lambda c, at, n: F.substring(c, at, n)
    upper = F.upper(F.translate(part(b, 5, 16), "+/", "QZ"))
    number = F.translate(h, "abcdef", "012345")
    one, two, three = words
    joined = lambda sep, *c: F.concat_ws(sep, *c)
    capital = lambda c: F.initcap(c)
    return [
        (1, part(h, 1, 40), 'token = "', '"'), (1, part(h, 1, 18), "password=", ""), (1, part(h, 1, 32), "api_key: ", ""),
        (1, part(b, 1, 40), "AWS_SECRET_ACCESS_KEY=", ""), (1, F.concat(F.lit("AKIA"), upper), "", ""), (1, part(b, 1, 36), "Bearer ", ""),
        (1, F.concat(F.lit("ghp_"), F.translate(part(b, 1, 36), "+/", "Xy")), "", ""), (1, part(b, 1, 28), "use ", " here"),
        (1, F.concat(capital(one), part(number, 1, 4), F.lit("!")), "password: ", ""), (1, F.concat(part(b, 1, 5), F.lit("$"), part(h, 1, 4)), "pwd = '", "'"),
        (1, joined("-", one, two, three), 'passphrase_secret="', '"'), (1, F.concat(F.lit("eyJ"), b, F.lit("."), part(b, 3, 30)), "auth=", ""),
        (0, F.concat(one, F.lit("."), two, F.lit("@"), three, F.lit(".example.com")), "", ""), (0, part(number, 1, 16), "", ""),
        (0, F.concat(F.lit("https://www."), one, F.lit(".org/"), two, F.lit("/"), part(number, 1, 6)), "", ""),
        (0, joined("-", part(h, 1, 8), part(h, 9, 4), part(h, 13, 4), part(h, 17, 4), part(h, 21, 12)), "id ", ""),
        (0, part(h, 1, 40), "commit ", ""), (0, F.concat(F.lit("v"), part(number, 1, 1), F.lit("."), part(number, 2, 2), F.lit("."), part(number, 4, 5), F.lit("-rc1")), "", ""),
        (0, F.concat(one, capital(two), capital(three)), "", ""), (0, joined("_", one, two, part(number, 1, 3)), "", ""), (0, two, "author: ", ""),
        (0, F.lit("changeme"), "password=", ""), (0, F.concat(F.lit("your_"), one, F.lit("_here")), "token: ", ""), (0, F.lit("string"), "secret: ", ""),
        (0, one, "the token ", ""), (0, F.concat(part(number, 1, 4), F.lit("-0"), part(number, 5, 1), F.lit("-1"), part(number, 6, 1), F.lit("T12:30")), "date=", ""),
        (0, F.concat(one, F.lit("/"), two, F.lit("/"), three, part(number, 1, 2), F.lit(".html")), "", ""), (0, three, "color=", ""),
        (0, joined("-", one, two, part(number, 1, 4)), "class=\"", "\""), (0, F.concat(F.lit("+"), part(number, 1, 11)), "Tel: ", ""),
    ]


def planted_findings(docs: DataFrame, words: DataFrame, max_documents: int = MAX_PLANTED, held_out: bool = False, id_col: str = "doc_id",
                     text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Findings with FEATURES and ``label``: values of known kind between words of at most ``max_documents`` documents.

    Documents of one fold (crc32 of the id modulo 5 is 0) only serve ``held_out`` findings.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    fold = F.pmod(F.crc32(key), F.lit(5)) == 0
    order = F.xxhash64(key, F.lit(3))
    chosen = docs.where((fold if held_out else ~fold) & (F.length(text_col) > 0)).select(order.alias("_key")).orderBy("_key").limit(max_documents)
    chosen = written(spark, chosen.distinct(), "planted-documents")
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    lower = F.regexp_extract_all(F.lower(F.substring_index("_text", " ", 60)), F.lit("[a-z]{3,9}"), F.lit(0))
    rows = (docs.select(order.alias("_key"), path.alias("path"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(chosen), "_key").dropDuplicates(["_key"])
            .select("_key", "path", _once(F.substring_index("_text", " ", 12)).alias("_head"), lower.alias("_lower")))
    pick = lambda k: F.coalesce(F.get("_lower", F.pmod(F.col("_key") + k * k, F.size("_lower")).cast("int")), F.lit("some"))
    rows = rows.where(F.size("_lower") > 0).select("_key", "path", "_head", F.col("_lower"))
    digest = lambda k: F.sha2(F.concat(F.col("_key").cast("string"), F.lit(f":{k}")), 256)
    number = len(_planted(F.lit("00" * 32), [F.lit("a")] * 3))
    kinds = []
    for k in range(number):
        label, value, before, after = _planted(digest(k), [pick(k + 1), pick(k + 5), pick(k + 11)])[k]
        kinds.append(F.struct(F.lit(k).alias("kind"), F.lit(float(label)).alias("label"), value.alias("value"),
                              F.concat(F.lit(before), value, F.lit(after)).alias("phrase")))
    rows = rows.select("_key", "path", "_head", pick(2).alias("_tail"), F.explode(F.array(*kinds)).alias("k"))
    rows = rows.select(F.xxhash64("_key", "k.kind").alias("doc_id"), "path", F.col("k.label").alias("label"), F.col("k.value").alias("value"),
                       F.concat_ws(" ", "_head", "k.phrase", "_tail").alias("text"))
    rows = written(spark, rows, "planted-texts")
    found = candidates(rows, path_col="path").join(rows.select("doc_id", "label", "value"), "doc_id").where(
        (F.col("candidate") == F.col("value")) | ((F.col("label") == 0) & F.col("value").contains(F.col("candidate")) & (F.length("candidate") > 3)))
    return features(written(spark, found.drop("value"), "planted-candidates"), words)


def train(labelled: DataFrame, max_labelled: int = MAX_LABELLED, trees: int = 40, depth: int = 8):
    """A forest on ``labelled`` (FEATURES and ``label``), a float if all labels are one, or None."""
    sample = (labelled.where("label IS NOT NULL")
              .select("label", *FEATURES, F.xxhash64("doc_id", "start", "candidate").alias("_order"))
              .orderBy("_order", *FEATURES).limit(max_labelled))
    sample = written(labelled.sparkSession, sample, "labelled-findings")
    kinds = [r[0] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else None
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(sample)


def score(found: DataFrame, model, cut: float = 0.5) -> DataFrame:
    if hasattr(model, "transform"):
        out = model.transform(found).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    else:
        out = found.withColumn("score", F.lit(model).cast("double"))
    return out.withColumn("is_secret", F.coalesce(F.col("score") >= cut, F.lit(False)).cast("int"))


def scan(docs: DataFrame, words: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text", path_col: str | None = "source", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """All candidates with their score; the candidate itself is shown by its first characters (four at most, and
    no more than a quarter) and a digest.  ``labelled``: findings with FEATURES and label; by default those of
    ``label_findings`` outside of a fifth of the documents."""
    found = written(docs.sparkSession, candidates(docs, id_col, text_col, path_col), "candidates")
    found = written(docs.sparkSession, features(found, words), "findings")
    if labelled is None:
        labelled = label_findings(found.where(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) != 0))
    out = score(found, train(labelled, max_labelled))
    shown = F.expr("substring(candidate, 1, least(4, length(candidate) div 4))")
    return out.select("doc_id", "path", "start", F.length("candidate").cast("long").alias("n_chars"),
                      F.concat(shown, F.lit("...")).alias("shown"),
                      F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")
