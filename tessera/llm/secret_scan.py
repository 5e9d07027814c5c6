"""Secret scanning: candidates by one pattern, false positives removed by a random forest, all in DataFrame functions.

A candidate is a vendor's key, with or without a digit; or what follows a secret's name and = or : (up to two blanks before
and four behind) at any length: to the closing quote, or without quotes to white space, a quote, an angle bracket or the next
assignment; or a run of at least ``MIN_LENGTH`` key characters that holds a digit, where = only ends a run and a
secret's name before = or : is no value.  Features are its length, class mixture and character transitions, the share of it that dictionary words cover, whether it
looks like a path or stands in one, and the words beside it.  The forest (Spark ML, on the JVM) is fitted on
labelled findings; without a table of such, :func:`weak_findings` labels a bounded sample of the corpus by rules of
high precision: assignments to a secret's name and vendor formats are secrets; candidates of one class, with plain
words beside them, are not.  The forest sees only the features (some of which, like ``named`` and ``quoted``, follow the same
signs as the rules) and scores every finding.

Defined cases: null and empty texts hold no finding; a null ``doc_id`` is kept; repeated rows give repeated
findings, which the sample holds once; without findings of both labels the rules decide each finding, and those that no rule
labels get the only label there is, or are accepted when there is none; very long texts are read whole, in time
almost linear in their findings; empty tables hold no finding; other columns, whatever their names, pass
through ``redact`` and are ignored by ``scan``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import every, free_name, stored

MIN_LENGTH = 16
FIT_ROWS = 20_000
SLICE = 500  # sampled findings of one label in one range of hashes; Spark limits windows before the exchange up to 1,000 rows
TREES = 20
DEPTH = 6
THRESHOLD = 0.5
MASK = "[SECRET]"
# Names that secrets are assigned to, and formats that vendors publish for their keys.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key", "auth", "credential",
                "private_key", "client_secret")
VENDOR_FORMATS = ("AKIA[0-9A-Z]{16}", "ghp_[0-9A-Za-z]{36}", "sk_live_[0-9A-Za-z]{24,}", "xox[abp]-[0-9A-Za-z-]{10,}",
                  "AIza[0-9A-Za-z_-]{35}", "eyJ[0-9A-Za-z_-]{10,}")
DICTIONARY = ("about", "access", "admin", "class", "config", "content", "data", "date", "default", "error", "example", "file",
              "from", "have", "home", "html", "http", "image", "index", "info", "item", "list", "local", "mail", "name", "node",
              "number", "page", "path", "public", "search", "server", "service", "source", "system", "test", "text", "that",
              "this", "time", "type", "user", "value", "version", "with", "year")
_KEY = "A-Za-z0-9+/_\\-"
_END = "\\s\"'<>"


def _behind_name(tail: str) -> str:
    """Behind a secret's name, = or : and ``tail``: look-behinds of one width each, which Python's patterns need too."""
    by_width: dict[int, list[str]] = {}
    for name in SECRET_NAMES:
        by_width.setdefault(len(name), []).append(name)
    name = "(?:" + "|".join(f"(?<=(?i:{'|'.join(same)}))" for same in by_width.values()) + ")"
    # the last characters are tested first: few places have them
    ways = [f"(?<=[=:][ \\t]{{{after}}}{tail})(?:" + "|".join(
        f"(?<={name}[\"']{{{quote}}}[ \\t]{{{before}}}[=:][ \\t]{{{after}}}{tail})" for quote in (0, 1) for before in range(3)) + ")" for after in range(5)]
    return "(?:" + "|".join(ways) + ")"


_VENDOR = f"(?:{'|'.join(VENDOR_FORMATS)})"
# nothing starts behind a letter or digit, which one look-behind rules out for all kinds
PATTERN = "(?<![A-Za-z0-9])(?:" + "|".join((
    f"{_VENDOR}(?![{_KEY}])",
    rf"""(?<="){_behind_name('"')}[^"\r\n]+(?=")""",
    rf"""(?<='){_behind_name("'")}[^'\r\n]+(?=')""",
    rf"""(?<=[=: \t]){_behind_name('')}[^{_END}]+?(?=[.,;:)\]}}]*(?:[{_END}]|(?![\s\S]))|[,;&][A-Za-z_][A-Za-z0-9_.\-]*[=:])""",
    rf"(?<![{_KEY}])(?=[A-Za-z+/_\-]*[0-9])[{_KEY}]{{{MIN_LENGTH},}}+(?!(?:{'|'.join(f'(?<=(?i:{n}))' for n in SECRET_NAMES)})[\"']?[ \t]{{0,2}}[=:])(?:={{1,2}}(?![{_KEY}=\"']))?",
    f"{_VENDOR}(?![A-Za-z0-9])")) + ")"
FEATURES = ("length", "distinct", "lower", "upper", "digit", "mark", "hex_only", "transitions", "same_next", "dictionary", "longest_letters",
            "slashes", "in_path", "named", "assigned", "quoted", "left_word", "right_word", "left_digit", "right_digit")


def _running(sizes: Column, at: Column) -> Column:
    """For each of ``sizes`` the sum of those before it and ``at``."""
    return F.aggregate(
        sizes, F.struct(at.alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")), lambda s: s["out"])


def findings(docs: DataFrame) -> DataFrame:
    """One row per candidate: ``doc_id, finding (0, 1, ..), start (in characters, from 0), value, left, right``.

    The texts between the candidates come from splitting by the same pattern, so starts are sums of lengths: sums within
    blocks of as many candidates as there are blocks, then over blocks, because appending to one array copies it each time.
    """
    # not filtered: Spark would push a filter on the candidates below and search every text again
    hit = docs.select("doc_id", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("_m"), "text")
    # what the rows need of the text between the candidates: its length and the ends that touch a candidate
    around = F.transform(F.split("text", PATTERN, -1), lambda s: F.struct(
        F.length(s).alias("n"), F.substring(s, -48, 48).alias("tail"), F.substring(s, 1, 48).alias("head")))
    hit = hit.select("doc_id", "_m", F.when(F.size("_m") > 0, around).alias("_a"))
    before = F.slice("_a", F.lit(1), F.size("_m"))
    sized = hit.select("doc_id", "_m", "_a", F.zip_with(before, "_m", lambda a, m: a["n"] + F.length(m)).alias("_s"))
    width = F.greatest(F.ceil(F.sqrt(F.size("_s"))).cast("int"), F.lit(1))
    in_blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_s") - 1) / width).cast("int")), lambda b: F.slice("_s", b * width + 1, width))
    blocks = sized.select("doc_id", "_m", "_a", F.when(F.size("_s") > 0, in_blocks).alias("_b"))
    sums = F.transform("_b", lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))
    starts = F.flatten(F.zip_with("_b", _running(sums, F.lit(0)), _running))
    rows = blocks.select("doc_id", F.posexplode_outer(F.arrays_zip(
        F.col("_m").alias("value"), starts.alias("start"), before.alias("before"), F.slice("_a", F.lit(2), F.size("_m")).alias("after"))).alias("finding", "_x"))
    return rows.where(F.col("finding").isNotNull()).select(
        "doc_id", "finding", (F.col("_x.start") + F.col("_x.before.n")).alias("start"), F.col("_x.value").alias("value"),
        F.col("_x.before.tail").alias("left"), F.col("_x.after.head").alias("right"))


def _share(pattern: str, of: str = "value") -> Column:
    return F.length(F.regexp_replace(of, f"[^{pattern}]", "")) / F.length(of)


def featured(rows: DataFrame) -> DataFrame:
    """``rows`` with a column for each of ``FEATURES``."""
    v = F.col("value")
    n = F.length(v).cast("double")
    yes = lambda c: c.cast("double")
    names = "|".join(SECRET_NAMES)
    letters = F.regexp_extract_all(v, F.lit("([A-Za-z]+)"), F.lit(1))
    return rows.select(
        "*", n.alias("length"), (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct"),
        _share("a-z").alias("lower"), _share("A-Z").alias("upper"), _share("0-9").alias("digit"), _share("+/_=\\-").alias("mark"),
        yes(v.rlike("^[0-9a-fA-F]+$")).alias("hex_only"),
        (F.regexp_count(v, F.lit("(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])")) / n).alias("transitions"),
        (F.regexp_count(v, F.lit("(.)(?=\\1)")) / n).alias("same_next"),
        (1 - F.length(F.regexp_replace(F.lower(v), "|".join(DICTIONARY), "")) / n).alias("dictionary"),
        (F.coalesce(F.array_max(F.transform(letters, lambda x: F.length(x))), F.lit(0)) / n).alias("longest_letters"),
        F.regexp_count(v, F.lit("/")).cast("double").alias("slashes"),
        yes(F.col("left").rlike("[/\\\\.@]$") | F.col("right").rlike("^\\.[A-Za-z]{2,4}\\b")).alias("in_path"),
        yes(F.col("left").rlike(f"(?i)({names})\\W*$")).alias("named"),
        yes(F.col("left").rlike("[=:]\\s*[\"']?$")).alias("assigned"),
        yes(F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']")).alias("quoted"),
        F.length(F.regexp_extract("left", "([\\p{L}]+)\\W*$", 1)).cast("double").alias("left_word"),
        F.length(F.regexp_extract("right", "^\\W*([\\p{L}]+)", 1)).cast("double").alias("right_word"),
        yes(F.col("left").rlike("[0-9]\\W{0,2}$")).alias("left_digit"),
        yes(F.col("right").rlike("^\\W{0,2}[0-9]")).alias("right_digit"))


def rule_label() -> Column:
    """Label 1: a vendor's format, or a value in quotes assigned to a secret's name.  Label 0: digits or letters of one
    case only, or a path, when no secret's name is beside it, and one plain word without quotes behind a secret's name and a
    colon ("password: required").  Null: no rule says."""
    names = "|".join(SECRET_NAMES)
    one = F.col("value").rlike(f"^({'|'.join(VENDOR_FORMATS)})$") | F.col("left").rlike(f"(?i)({names})[\"']?\\s*[=:]\\s*[\"']$")
    zero = (F.col("value").rlike("^[0-9\\-]+$") | F.col("value").rlike("^[a-z]+[0-9]{1,4}$") | F.col("value").rlike("(/[a-z0-9]+){2,}")) & ~F.col("left").rlike(f"(?i)({names})\\W*$")
    prose = F.col("value").rlike("^[A-Za-z]?[a-z]*$") & F.col("left").rlike(f"(?i)({names})\\s*:\\s*$")
    return F.when(one, 1.0).when(zero | prose, 0.0)


def weak_findings(rows: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """Distinct findings (``value, left, right``) with a rule's ``label``: of each label at most half of ``limit``.

    A label's hashes are dealt over ranges and the smallest of each range are taken, so that no task meets them all.
    """
    half = max(1, limit // 2)
    ranges = -(-half // SLICE)
    labelled = rows.select("value", "left", "right", rule_label().alias("label")).where(F.col("label").isNotNull()).distinct()
    hashed = labelled.withColumn("_h", F.xxhash64("value", "left", "right")).withColumn("_range", F.pmod("_h", F.lit(ranges)))
    place = F.row_number().over(W.partitionBy("label", "_range").orderBy("_h", "value", "left", "right"))
    return hashed.withColumn("_place", place).where(F.col("_place") <= half // ranges).drop("_h", "_range", "_place")


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_features", handleInvalid="keep").transform(featured(rows))


Forest = RandomForestClassificationModel | float


def fit(labelled: DataFrame) -> Forest:
    """A forest on findings with ``label`` 0 or 1; with one label only that label, with none 1, for findings that no rule labels."""
    kinds = {r[0] for r in labelled.select("label").distinct().limit(3).collect()}
    if kinds != {0.0, 1.0}:
        return min(kinds, default=1.0)
    return RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=TREES, maxDepth=DEPTH, seed=5, maxMemoryInMB=64).fit(_vectors(labelled))


def score(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` with ``score``, the forest's share of votes for a secret, or without a forest the rules' label."""
    if isinstance(forest, float):
        return rows.withColumn("score", F.coalesce(rule_label(), F.lit(forest)))
    return forest.transform(_vectors(rows)).withColumn("score", vector_to_array("probability")[1]).select(*rows.columns, "score")


def fit_on_findings(rows: DataFrame, limit: int = FIT_ROWS) -> Forest:
    sample = weak_findings(rows, limit).persist()
    try:
        return fit(sample)
    finally:
        sample.unpersist()


def fit_on(docs: DataFrame, limit: int = FIT_ROWS) -> Forest:
    return fit_on_findings(findings(docs), limit)


def judged(rows: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with score and verdict; values are given as digests only."""
    return score(rows, forest).select(
        "doc_id", "finding", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"),
        "score", (F.col("score") >= threshold).cast("int").alias("secret"))


def scan(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate of every whole text with its score and verdict."""
    return judged(findings(docs), forest, threshold)


def redact(docs: DataFrame, forest: Forest | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the text of each secret replaced by ``MASK``; every row and column stays.

    Without a forest, one is fitted on the findings of ``docs``, which are extracted once and stored.  Texts are known by their
    digest, which is also what rows with a null or repeated id need.  A text with a secret comes back as one
    row of verdicts, in the order of its findings, and is put together from its parts.  The verdicts are stored, so
    that their join with the rows has exchanges of its own, which AQE may split where one text fills many rows.
    """
    rows = findings(docs.select(F.sha2("text", 256).alias("doc_id"), "text"))
    if forest is None:
        rows = stored(rows, "findings")
        forest = fit_on_findings(rows)
    key, flags, found = (free_name(docs, c) for c in ("key", "flags", "found"))
    each = judged(rows, forest, threshold).groupBy("doc_id", "finding").agg(F.max("secret").alias("secret"))
    in_order = F.sort_array(F.collect_list(F.struct("finding", "secret")))
    verdicts = (each.groupBy(F.col("doc_id").alias(key)).agg(F.max("secret").alias("any"), in_order.alias("s"))
                .where(F.col("any") == 1).select(key, F.transform("s", lambda x: x["secret"] == 1).alias(flags)))
    verdicts = stored(verdicts, "verdicts")
    # a null key meets nothing, so only texts with a candidate travel
    marked = docs.withColumn(key, F.when(F.col("text").rlike(PATTERN), F.sha2("text", 256)))
    columns = every(docs)
    clear = marked.where(F.col(key).isNull()).select(*columns)
    held = marked.where(F.col(key).isNotNull()).join(verdicts, key, "left")
    held = held.withColumn(found, F.when(F.col(flags).isNotNull(), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))))
    shown = F.transform(found, lambda m, i: F.when(F.get(flags, i), F.lit(MASK)).otherwise(m))
    parts = F.zip_with(F.split("text", PATTERN, -1), shown, lambda between, m: F.concat(between, F.coalesce(m, F.lit(""))))
    masked = F.when(F.col(flags).isNotNull(), F.array_join(parts, "")).otherwise(F.col("text"))
    return clear.unionByName(held.withColumn("text", masked).select(*columns))


def op8_random_forest_secrets(spark, sf_dir: str) -> DataFrame:
    rows = stored(findings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), "findings")
    return judged(rows, fit_on_findings(rows))
