"""Secrets in texts, with DataFrame functions only: known forms, and tokens that pass a battery of randomness tests.

A token of one inferred encoding is tested for a uniform alphabet (chi-squared), for runs above and below the
middle of the alphabet, and for correlation of neighbours. How well tokens made of the corpus's own frequent words pass the same battery, by
class of length and encoding, gives the expected share of false finds; the lowest threshold that keeps it under the wanted
rate is used in each class and encoding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spans import located
from tidemark.session import materialize

# The known forms.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

# A token: 20 or more letters, digits and signs of the encodings, not inside a longer one.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings, the first that fits being inferred: name, form, alphabet.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex_upper", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+={0,2}$", UPPER + "234567"),
    ("alphanumeric", r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", r"^[A-Za-z0-9+/]+={0,2}$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+={0,2}$", UPPER + LOWER + DIGITS + "-_"),
)
# Lower ends of the length classes.
LENGTHS = (20, 24, 32, 40, 48, 64)
# Expected share of false finds, and thresholds tried: a token is found if its p-value is at least 10^-step.
RATE = 0.01
STEPS = 6
# Random tokens hardly ever lie beyond this step, so those beyond it tell how many ordinary ones the candidates hold.
ORDINARY_STEP = 2
# Frequent words of the corpus, where each is found so often at least, and the share of a token's runs of GRAM letters that is theirs in a token of words.
WORD = r"^[a-z]{4,15}$"
WORDS, WORD_COUNT, GRAM, WORD_SHARE = 20_000, 5, 4, 0.3


def two_sided(z: Column) -> Column:
    """p-value of a standard normal |z|, by a rational approximation of the error function (error under 2e-7)."""
    x = F.abs(z) / (2**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), poly * F.exp(-x * x)))


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (value) with encoding and p: the smallest of the three p-values, times three; 0 where no encoding fits."""
    body = F.regexp_replace("value", "=+$", "")
    name = F.coalesce(*[F.when(F.col("value").rlike(form), F.lit(n)) for n, form, _ in ENCODINGS])
    alphabet = F.coalesce(*[F.when(F.col("encoding") == n, F.lit(letters)) for n, _, letters in ENCODINGS])
    data = tokens.withColumn("encoding", name).withColumn("alphabet", alphabet).withColumn("body", body)
    codes = F.expr("transform(filter(split(body, ''), c -> c <> ''), c -> cast(instr(alphabet, c) - 1 as double))")
    data = data.withColumn("codes", F.when(F.col("encoding").isNotNull(), codes))
    data = data.withColumn("n", F.size("codes").cast("double")).withColumn("a", F.length("alphabet").cast("double"))
    # How often a letter occurs, from the length without it.
    counts = F.expr("aggregate(transform(filter(split(alphabet, ''), c -> c <> ''), c -> cast(length(body) - length(replace(body, c, '')) as double)), 0D, (s, k) -> s + k * k)")
    data = data.withColumn("chi", counts * F.col("a") / F.col("n") - F.col("n"))
    data = data.withColumn("mean", F.expr("aggregate(codes, 0D, (s, x) -> s + x) / n"))
    data = data.withColumn("high", F.expr("aggregate(codes, 0D, (s, x) -> s + if(x >= a / 2, 1, 0))"))
    data = data.withColumn("runs", F.expr("1D + size(filter(sequence(1, size(codes) - 1), i -> (codes[i] >= a / 2) <> (codes[i - 1] >= a / 2)))"))
    data = data.withColumn("var", F.expr("aggregate(codes, 0D, (s, x) -> s + (x - mean) * (x - mean))"))
    data = data.withColumn("lag", F.expr("aggregate(sequence(1, size(codes) - 1), 0D, (s, i) -> s + (codes[i] - mean) * (codes[i - 1] - mean))"))
    uniform = (F.col("chi") - (F.col("a") - 1)) / F.sqrt(2 * (F.col("a") - 1) * (F.col("n") - 1) / F.col("n"))
    both = 2 * F.col("high") * (F.col("n") - F.col("high"))
    spread = F.sqrt(both * (both - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1)))
    runs = F.when(both > F.col("n"), (F.col("runs") - 1 - both / F.col("n")) / spread).otherwise(F.lit(99.0))
    serial = F.when(F.col("var") > 0, (F.col("lag") / F.col("var") + 1 / (F.col("n") - 1)) * F.sqrt("n")).otherwise(F.lit(99.0))
    p = F.least(F.lit(1.0), 3 * F.least(two_sided(uniform), two_sided(runs), two_sided(serial)))
    return data.select(*tokens.columns, "encoding", F.when(F.col("n") > 2, p).otherwise(F.lit(0.0)).alias("p"))


def frequent_grams(docs: DataFrame) -> DataFrame:
    """Runs of GRAM letters (gram) of the most frequent words of ``docs`` (text) that stand alone."""
    word = F.explode(F.split(F.lower("text"), r"[^A-Za-z0-9+/_-]+")).alias("word")
    words = docs.select(word).where(F.col("word").rlike(WORD)).groupBy("word").count().where(F.col("count") >= WORD_COUNT)
    words = words.orderBy(F.desc("count"), "word").limit(WORDS)
    return words.select(F.explode(grams_of("word")).alias("gram")).distinct()


def grams_of(text: str) -> Column:
    return F.expr(f"regexp_extract_all({text}, '(?=(.{{{GRAM}}}))', 1)")


def worded(values: DataFrame, grams: DataFrame) -> DataFrame:
    """The ids of those of ``values`` (id, value; distinct) made of words: WORD_SHARE of the runs of GRAM letters, signs and digits left out, are ``grams``."""
    runs = values.withColumn("letters", F.regexp_replace(F.lower("value"), "[^a-z]", "")).select("id", F.explode(grams_of("letters")).alias("gram"))
    runs = runs.join(F.broadcast(grams.withColumn("known", F.lit(1))), "gram", "left")
    return runs.groupBy("id").agg(F.count("known").alias("known"), F.count("*").alias("runs")).where(F.col("known") >= WORD_SHARE * F.col("runs")).select("id")


def random_tokens(tokens: DataFrame, grams: DataFrame, rate: float = RATE) -> DataFrame:
    """Of ``tokens`` (value, more columns) those found to be random, under false-discovery control by class of length and encoding.

    A token made of frequent words, as their ``grams`` tell, is ordinary, and shows how often such pass by chance; any other one
    with a letter is a candidate. Tokens of digits and signs only are neither. How many candidates are ordinary follows from those that fail clearly. From
    the step on that holds over ten times as many candidates as random ones leave for it, they are taken for ordinary as well.
    """
    length = F.coalesce(*[F.when(F.length("value") >= low, F.lit(low)) for low in reversed(LENGTHS)])
    distinct = materialize(tokens.where(F.col("value").rlike("[A-Za-z]")).groupBy("value").agg(F.count("*").alias("times")).withColumn("id", F.md5("value")))
    words = worded(distinct.select("id", "value"), grams).withColumn("word", F.lit(True))
    tested = battery(distinct.join(words, "id", "left")).withColumn("class", length).withColumn("candidate", F.col("word").isNull()).where("encoding is not null")
    tested = materialize(tested.withColumn("step", F.least(F.lit(STEPS + 1), F.ceil(-F.log10(F.greatest("p", F.lit(1e-30)))).cast("int"))))
    # A p of 1 is of the first step.
    tested = tested.withColumn("step", F.greatest("step", F.lit(1)))
    tally = tested.groupBy("class", "encoding", "step").agg(F.count_if("candidate").alias("new"), F.count_if(~F.col("candidate")).alias("plain"))
    upto = Window.partitionBy("class", "encoding").orderBy("step")
    whole = Window.partitionBy("class", "encoding")
    failed = [F.sum(F.when(F.col("step") > ORDINARY_STEP, F.col(c)).otherwise(0)).over(whole).alias(f"failed_{c}") for c in ("new", "plain")]
    tally = tally.select("class", "encoding", "step", "new", F.sum("new").over(upto).alias("found"), F.sum("plain").over(upto).alias("plain"), F.sum("new").over(whole).alias("all_found"), F.sum("plain").over(whole).alias("all_plain"), *failed)
    # Half a pass in a hundred words, which fail otherwise, stands for what a small table cannot show.
    ordinary = F.least("all_found", F.col("failed_new") * (F.col("all_plain") + 100) / (F.col("failed_plain") + 100))
    false = (F.col("plain") + 0.5) / (F.col("all_plain") + 100) * ordinary / F.greatest("found", F.lit(1))
    crowded = (F.col("step") > 1) & (F.col("new") > F.pow(F.lit(10.0), 2 - F.col("step")) * (F.col("found") - F.col("new")))
    tally = tally.withColumn("false", false).withColumn("crowded", F.max(crowded).over(upto))
    limits = tally.where((F.col("step") <= STEPS) & (F.col("false") <= rate + 1e-12) & ~F.col("crowded")).groupBy("class", "encoding").agg(F.max("step").alias("limit"))
    # A row per length class and encoding.
    found = tested.join(F.broadcast(limits), ["class", "encoding"]).where("candidate and step <= limit").select("value")
    return tokens.join(found, "value").select(*tokens.columns)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; more columns are ignored): doc_id, base and spans.

    Both are array<struct<start, rank, kind, end>> sorted by start, then kind; ``base`` has the known forms (leftmost,
    non-overlapping within a kind, short ones dropped after matching), ``spans`` those and the random tokens. Places are in code
    points, end exclusive. A null or empty text has none. Repeated rows are rows of their own with equal spans; no rows give none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")

    def spans(found: Column, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    assigned = F.filter(located(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= ASSIGN_LEAST)
    base = F.array_sort(F.concat(spans(assigned, "assign"), spans(located(text, ACCESS), "access"), spans(located(text, HEX), "hex")))
    key = F.xxhash64("text").alias("row")
    rows = docs.select("doc_id", key, base.alias("base"))
    tokens = docs.select("doc_id", key, F.explode(located(text, TOKEN)).alias("token")).select("doc_id", "row", "token.*")
    found = random_tokens(materialize(tokens), materialize(frequent_grams(docs)))
    extra = found.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", F.lit(3).alias("rank"), F.lit("random").alias("kind"), "end")).alias("extra"))
    extra = extra.withColumnsRenamed({"doc_id": "its_doc", "row": "its_row"})
    joined = rows.join(extra, F.col("doc_id").eqNullSafe(F.col("its_doc")) & (F.col("row") == F.col("its_row")), "left")
    return joined.select("doc_id", "base", F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra"))).alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
