"""Secret scans: candidates from text, and a random forest that removes false positives. DataFrame operations only.

A candidate is a run of letters, digits and + / _ - of at least ``SHORTEST`` characters with a digit in it, or any value of at least
``LEAST`` characters after a credential word and = or : (findings may overlap where the two differ). Features are its length,
shares and transitions of character classes, distinct characters, how much of it dictionary words cover, whether it is part
of a path or address, whether it has a provider's form, and the neighbouring words. The forest learns from labelled
findings: a table given by the caller, or ``labelled_findings`` - made-up findings of known kind, and findings of the documents
whose form or context settles what they are (at most ``TRAIN_ROWS``, by hash). Candidates are scored in whole texts.

Contract: null and empty texts have no candidates. Positions count characters from 1. Rows with equal doc_id are scanned
each; ``redact`` hides a secret found under a doc_id in all rows of this doc_id. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHORTEST = 12
TRAIN_ROWS = 20_000
CUT = 0.5
HIDDEN = "[SECRET]"
BEFORE, AFTER = 48, 16

CANDIDATE = rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{{{SHORTEST},}}+={{0,2}}"

# A value after a credential word and = or :, up to a space, a quote, or a separator before the next name. The word may go on as
# a name (secret_key, token2). Closing punctuation is not part of the value.
LEAST = 6
CREDENTIAL = r"(?i:password|passwd|pwd|passphrase|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|bearer|credential)"
NAME_END = r"(?i:s|[_-]?(?:key|value|string|token|hash))?(?:[_-][A-Za-z0-9]{1,20}){0,3}[0-9]{0,3}"
ASSIGNMENT = CREDENTIAL + NAME_END + r"[\"'`]?[ \t]{0,4}(?::=|=>|[=:]{1,2})[ \t]{0,4}[\"'`]?"
_PLAIN = r"[^\s\"'`<>&,;]"
ASSIGNED = ASSIGNMENT + rf"{_PLAIN}++(?:[&,;](?![\w-]{{1,40}}[=:]|[\s\"'`<>]|$){_PLAIN}*+){{0,200}}+"
CLOSING = r"[.,;:)\]}]+$"

# Public key forms of providers, and words around and within findings.
PROVIDERS = (r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^glpat-[A-Za-z0-9_-]{20}|^xox[abprs]-[A-Za-z0-9-]{10}|^AIza[A-Za-z0-9_-]{35}$"
             r"|^sk_(live|test)_[A-Za-z0-9]{16}|^eyJ[A-Za-z0-9_-]{16}|^npm_[A-Za-z0-9]{36}$")
HARMLESS = r"(?i)(sha|commit|md5|checksum|digest|uuid|guid|isbn|order|invoice|phone|card|iban|account|version|build|example|sample|image|file|page|id)\W*$"
DICTIONARY = ("the and for that with this from have are was not you all can has had but his her they one our out day get use man new now "
              "way may say she two how its who did yes test example sample dummy user name file image page data value key token index "
              "config system server local default version build release report table number order date time item list der die das und "
              "nicht mit les des une pour dans que los las por con para ing ion ent est").split()


def _located(docs: DataFrame, pattern: str, name: str) -> DataFrame:
    """``docs`` with an array of start, value, before, after of every match of ``pattern`` in the text."""
    values, gaps = F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1)
    # gap, match, gap, match, ..., gap, null: the whole text
    docs = docs.withColumn("pieces", F.flatten(F.zip_with(gaps, values, lambda g, v: F.array(g, v))))
    ends = F.aggregate(
        F.transform("pieces", lambda p: F.coalesce(F.length(p), F.lit(0))),
        F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    cut = lambda at, n: F.array_join(F.slice("pieces", at, n), "")
    # a match has LEAST characters or more: so many pieces hold BEFORE and AFTER characters
    back, ahead = 2 * -(-BEFORE // LEAST) + 1, 2 * -(-AFTER // LEAST) + 1
    # ends is read once, so it is not worked out again for each match
    found = F.transform(ends, lambda at, i: F.when((i % 2 == 1) & (i < F.size("pieces") - 1), F.struct(
        (at + 1).alias("start"), F.get("pieces", i).alias("value"),
        F.right(cut(F.greatest(i - back + 1, F.lit(1)), F.least(i, F.lit(back))), F.lit(BEFORE)).alias("before"),
        F.left(cut(i + 2, F.lit(ahead)), F.lit(AFTER)).alias("after"))))
    return docs.withColumn(name, F.filter(found, lambda c: c.isNotNull())).drop("pieces")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start, value, before, after of every candidate; one that both patterns find is one row."""
    found = docs.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(ASSIGNED)).select("doc_id", "text")
    found = _located(_located(found, CANDIDATE, "runs"), ASSIGNED, "assigned").drop("text")
    skip = lambda c: F.length(F.regexp_extract(c["value"], "^" + ASSIGNMENT, 0))
    own = lambda c: F.regexp_replace(F.substr(c["value"], skip(c) + 1), CLOSING, "")
    values = F.transform("assigned", lambda c: F.struct(
        (c["start"] + skip(c)).alias("start"), own(c).alias("value"), F.right(F.concat(c["before"], F.left(c["value"], skip(c))), F.lit(BEFORE)).alias("before"),
        F.left(F.concat(F.regexp_extract(F.substr(c["value"], skip(c) + 1), CLOSING, 0), c["after"]), F.lit(AFTER)).alias("after")))
    values = F.filter(values, lambda c: F.length(c["value"]) >= LEAST)
    span = lambda c: c["start"].cast("long") * (1 << 31) + F.length(c["value"])
    found = found.withColumn("assigned", values).withColumn("spans", F.transform("assigned", span))
    every = F.concat("assigned", F.filter("runs", lambda c: ~F.array_contains("spans", span(c))))
    return found.select("doc_id", F.explode(every).alias("c")).select("doc_id", "c.start", "c.value", "c.before", "c.after")


def _share(pattern: str) -> Column:
    """Share of a candidate's characters in a class."""
    return (F.length("value") - F.length(F.regexp_replace("value", pattern, ""))) / F.length("value")


def features(found: DataFrame) -> DataFrame:
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0"), "[^aB0]", "-")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    words = "(?i)" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    flag = lambda c: c.cast("double")
    return found.withColumns({
        "f_length": F.least(F.length("value"), F.lit(200)).cast("double"),
        "f_transitions": (runs - 1) / F.length("value"),
        "f_digits": _share("[0-9]"), "f_upper": _share("[A-Z]"), "f_lower": _share("[a-z]"),
        "f_hex": flag(F.col("value").rlike("^[0-9a-f]+$") | F.col("value").rlike("^[0-9A-F]+$")),
        "f_only_digits": flag(F.col("value").rlike("^[0-9_/+-]+$")),
        "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / F.least(F.length("value"), F.lit(40)),
        "f_dictionary": (F.length("value") - F.length(F.regexp_replace("value", words, ""))) / F.length("value"),
        "f_path": flag(F.col("value").rlike("/.*/") | F.col("before").rlike(r"(://|www\.|[/\\.])\S*$") | F.col("after").rlike(r"^(\.\w|/|@)")),
        "f_parts": F.size(F.split("value", "[-_/+]")).cast("double"),
        "f_provider": flag(F.col("value").rlike(PROVIDERS)),
        "f_credential": flag(F.col("before").rlike(CREDENTIAL + NAME_END + r"\W{0,6}$")),
        "f_assigned": flag(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        "f_quoted": flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "f_harmless": flag(F.col("before").rlike(HARMLESS)),
    })


FEATURES = ("f_length", "f_transitions", "f_digits", "f_upper", "f_lower", "f_hex", "f_only_digits", "f_distinct", "f_dictionary", "f_path",
            "f_parts", "f_provider", "f_credential", "f_assigned", "f_quoted", "f_harmless")


def made_up_findings(spark: SparkSession, each: int = 200) -> DataFrame:
    """Findings of known kind: before, value, after, label. Values come from hashes of row numbers."""
    rows = spark.range(0, each, 1, 1).withColumns({
        "hex": F.sha2(F.col("id").cast("string"), 256), "b64": F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), "id"), 256))),
        "number": F.lpad(F.pmod(F.xxhash64("id"), F.lit(10 ** 16)).cast("string"), 16, "4"),
    })
    upper = F.upper(F.translate("b64", "+/=abcdefghijklmnopqrstuvwxyz", "XYZ"))
    dashed = F.concat_ws("-", *[F.substring("hex", i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    word = lambda k: F.element_at(F.array(*map(F.lit, DICTIONARY)), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(DICTIONARY))) + 1).cast("int"))
    cases = [
        ("access key ", F.concat(F.lit("AKIA"), F.rpad(upper, 16, "7")), " ", 1), ("the ", F.concat(F.lit("AKIA"), F.rpad(upper, 16, "3")), " to", 1),
        ('token = "', F.substring("hex", 1, 40), '"', 1), ("password=", F.substring("hex", 1, 18), " ", 1), ("password: ", F.substring("b64", 1, 14), "\n", 1),
        ("secret = '", F.col("b64"), "'", 1), ("api_key=", F.substring("hex", 1, 32), "&", 1), ("export TOKEN=", F.concat(F.lit("ghp_"), F.substring("hex", 1, 36)), "\n", 1),
        ("Authorization: Bearer ", F.concat(F.lit("eyJ"), F.translate(F.substring("b64", 1, 40), "+/=", "___")), ".", 1),
        ("commit ", F.substring("hex", 1, 40), " fixes", 0), ("sha256:", F.col("hex"), "\n", 0), ("id=", dashed, " ", 0), ("the order ", F.col("number"), ".", 0),
        ("call ", F.substring("number", 1, 12), ", ", 0), ("https://a.example/", F.concat_ws("/", word(1), word(2), F.substring("number", 1, 4)), ".html", 0),
        ("see ", F.concat_ws("_", word(3), word(4), word(5), F.substring("number", 1, 3)), ".", 0), ("und ", F.concat(word(6), word(7), word(8), F.substring("number", 1, 2)), " ", 0),
        ("of ", F.concat(word(1), word(5), word(9), word(2), F.lit("1")), "", 0), ("on ", F.concat(F.lit("2024-0"), F.substring("number", 2, 1), F.lit("-11-10")), " ", 0),
    ]
    letters = F.translate("hex", "0123456789", "ghjkmnpqrs")
    mixed = F.translate("b64", "0123456789+/=", "abcdefGHIJKLM")
    symbols = F.concat(F.substring("b64", 1, 4), F.element_at(F.array(*map(F.lit, ".!@#$%&:")), (F.col("id") % 8 + 1).cast("int")), F.substring("b64", 5, 5))
    cases += [
        ("password=", symbols, " ", 1), ("pwd: ", F.substring(symbols, 2, 7), "\n", 1), ('"passphrase": "', F.concat(symbols, symbols), '",', 1),
        ('password = "', F.substring(letters, 1, 10), '"', 1), ("secret=", F.substring(mixed, 1, 16), " ", 1), ("password=", F.substring("b64", 1, 8), "\n", 1),
        ('aws_s3_secret_key = "', F.substring("b64", 1, 40), '"', 1), ('oauth2_client_secret="', F.substring(mixed, 1, 24), '"', 1),
        ("password: ", F.concat(word(11), word(12)), " ", 0), ("the secret: ", F.concat(word(13), word(14), word(15)), ", ", 0),
        ("token=", F.concat(F.lit("${"), word(16), F.lit("_"), word(17)), "}", 0), ("auth: ", F.concat_ws(".", word(18), word(19)), "(", 0),
    ]
    found = [F.struct(F.lit(b).alias("before"), v.alias("value"), F.lit(a).alias("after"), F.lit(y).alias("label")) for b, v, a, y in cases]
    return rows.select(F.inline(F.array(*found)))


def labelled_findings(found: DataFrame) -> DataFrame:
    """Findings of the documents with a settled label, and made-up ones of all kinds; at most ``TRAIN_ROWS`` of the former."""
    marked = features(found)
    word = F.col("value").rlike("^[A-Za-z]?[a-z]+$") & (F.col("f_quoted") == 0)
    secret = (F.col("f_provider") == 1) | ((F.col("f_credential") == 1) & (F.col("f_assigned") == 1) & (F.col("f_distinct") > 0.25) & (F.col("f_dictionary") < 0.4) & ~word)
    plain = (F.col("f_only_digits") == 1) | (F.col("f_dictionary") > 0.6) | ((F.col("f_path") == 1) & (F.col("f_credential") == 0))
    settled = marked.withColumn("label", F.when(secret, 1).when(plain, 0)).where("label IS NOT NULL")
    settled = settled.select("before", "value", "after", "label").orderBy(F.xxhash64("before", "value"), "value", "before").limit(TRAIN_ROWS)
    return settled.union(made_up_findings(found.sparkSession))


def fit(labelled: DataFrame, seed: int = 7) -> RandomForestClassificationModel:
    """Forest of labelled findings (before, value, after, label)."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(labelled))
    forest = RandomForestClassifier(numTrees=40, maxDepth=7, featureSubsetStrategy="sqrt", seed=seed, labelCol="label")
    return forest.fit(rows.select("features", F.col("label").cast("double").alias("label")))


def scan(docs: DataFrame, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """doc_id, start, value, probability of all candidates; learns a model from the documents' own findings if none is given."""
    found = candidates(docs)
    model = model or fit(labelled_findings(found))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(found))
    scored = model.transform(rows.select("doc_id", "start", "value", "features"))
    return scored.select("doc_id", "start", "value", F.round(vector_to_array("probability")[1], 6).alias("probability"))


def redact(docs: DataFrame, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """``docs`` with every secret replaced by HIDDEN in column text; an n_chars column follows the text."""
    secrets = scan(docs, model).where(F.col("probability") >= CUT)
    # grouped by document: no more than one text holds
    hidden = secrets.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct(-F.length("value"), "value"))).alias("found"))
    own, found = (next(n for n in (base + "_" * i for i in range(99)) if n not in docs.columns) for base in ("own", "found"))
    hidden = hidden.select(F.col("doc_id").alias(own), F.col("found.value").alias(found))
    joined = docs.join(hidden, F.col("doc_id").eqNullSafe(F.col(own)), "left")
    clean = F.aggregate(found, F.col("text"), lambda text, s: F.replace(text, s, F.lit(HIDDEN)))
    changed = {"text": F.when(F.col(found).isNull(), F.col("text")).otherwise(clean)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])
