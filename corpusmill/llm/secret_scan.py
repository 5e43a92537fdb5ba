"""Secret scan: candidates by pattern, false positives removed by a random forest trained from labelled findings."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.storage import materialize

#: How keys of well-known services begin; these need no digit, and no neighbour that says so.
PREFIXES = "AKIA|ASIA|AIza|gh[pousr]_|[sr]k_(?:live|test)_|xox[abpr]-"
_ASSIGNED = "(?<=[=:'\"\\x20])(?<=(?i:password|passwd|pwd|pass|secret|token|api_?key|auth)\\x20{0,2}[=:]\\x20{0,2}['\"]?)"
#: What may be a secret, of any length: what is assigned to a name that says so; a web token of three parts; a key with a
#: known prefix; and a run of 16 or more key characters with a digit. Runs are taken whole (possessively), so that the
#: search is linear.
CANDIDATE = (
    _ASSIGNED + "[^\\s'\"`<>(){}\\[\\],;]{6,}+|(?<![A-Za-z0-9_+/.@-])(?:eyJ[A-Za-z0-9_-]++\\.[A-Za-z0-9_-]++\\.[A-Za-z0-9_-]++"
    "|(?:" + PREFIXES + ")[A-Za-z0-9_+/-]{12,}+|(?=[A-Za-z_+/-]*+\\d)[A-Za-z0-9_+/-]{16,}+={0,2})(?![A-Za-z0-9_+/@-])"
)
#: What a text with a candidate has: 16 key characters in a row, the start of a web token, or an assignment to such a name.
_RUN, _NAME = "[A-Za-z0-9_+/-]{16}", "(?i)(?:password|passwd|pwd|pass|secret|token|api_?key|auth)\\x20{0,2}[=:]"
#: Words that neighbour secrets, and words that neighbour or contain examples, hashes and other harmless values.
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "auth", "bearer", "credential", "private", "access_key", "client_secret", "login", "pass")
HARMLESS_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "uuid", "guid", "id", "version", "build", "revision", "example", "sample", "placeholder", "dummy", "test", "call", "phone", "card", "account", "page", "file", "isbn", "order")
PATH_WORDS = ("test", "example", "sample", "fixture", "mock", "docs", "doc", "spec", "demo")
#: Words of the corpus that a dictionary holds at most, the documents that each is in at least, and its letters.
DICTIONARY_WORDS, LEAST_DOCS, WORD = 5000, 5, r"(?<!\p{L})[a-z]{4,20}(?!\p{L})"
#: Parts of a candidate that may be words: camel case and capitals are told apart.
_PIECE = "[A-Z]?[a-z]+|[A-Z]+"
FEATURES = ("length", "likelihood", "changes", "coverage", "digits", "letters", "mixed", "secret_near", "harmless_near", "secret_after", "harmless_after", "quoted", "assigned", "harmless_path", "prefixed")
#: Words that make harmless values in generated findings where there is no dictionary.
PLAIN_WORDS = ("river", "bottle", "lamp", "quick", "brown", "jump", "yellow", "cloud", "harbour", "silk", "umbrella", "kayak", "window", "grape", "dwarf", "jigsaw", "bamboo", "puzzle", "lemon", "falcon")
PLACEHOLDERS = ("changeme", "xxxxxxxx", "********", "undefined", "password", "your_key_here", "ENV_VALUE", "required", "optional")
#: Rows of labelled findings that a model is fitted on at most.
LABELLED_ROWS = 20_000
THRESHOLD = 0.5


def findings(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """A row per candidate of docs (doc_id, text): doc_id, path, place, before, candidate, after.

    place counts the candidates of a text from 0; before and after: up to three words on each side, with what stands
    between, to the candidate beside it. Cheap searches come first, so that few texts are read for CANDIDATE.
    """
    text = F.col("text")
    likely = text.rlike(_RUN) | text.contains("eyJ") | ((text.contains("=") | text.contains(":")) & text.rlike(_NAME))
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(where, F.lit("")).alias("path"), "text").where(likely & text.rlike(CANDIDATE))
    # what lies between two finds is at hand by splitting at them, so each context is cut from its own piece
    rows = rows.select("doc_id", "path", F.split("text", CANDIDATE, -1).alias("gaps"), F.posexplode(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).alias("place", "candidate"))
    before = F.regexp_extract(F.substring(F.element_at("gaps", F.col("place") + 1), -80, 80), "((?:\\S+\\s+){0,2}\\S*\\s*)$", 1)
    after = F.regexp_extract(F.substring(F.element_at("gaps", F.col("place") + 2), 1, 80), "^(\\S*(?:\\s+\\S+){0,3})", 1)
    return rows.select("doc_id", "path", F.col("place").cast("long").alias("place"), before.alias("before"), "candidate", after.alias("after"))


def _near(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("(?:^|[^a-z0-9])(?:" + "|".join(words) + ")(?:[^a-z0-9]|$)").cast("double")


@dataclass
class Language:
    """What a corpus tells of its words: the most frequent ones, and the logarithm to base 2 of a letter's chance behind another."""

    words: list[str] = field(default_factory=list)
    bigrams: dict[str, float] = field(default_factory=dict)


def language_of(docs: DataFrame) -> Language:
    """The language of docs (text), from all of its texts.

    Words count once a document, combined before the shuffle; the driver gets DICTIONARY_WORDS words and 676 pairs of
    letters at most. Null texts and an empty table have no words; pairs that were not seen count as if half a time.
    """
    own = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("word"))
    both = materialize(own.groupBy("word").count().where(F.col("count") >= LEAST_DOCS), "words")
    pairs = both.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("pair"), "count")
    pairs = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.sum("count").alias("n")).collect()}
    words = [r["word"] for r in both.orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS).collect()]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = {x: sum(pairs.get(x + y, 0) + 0.5 for y in letters) for x in letters}
    return Language(words, {x + y: math.log2((pairs.get(x + y, 0) + 0.5) / rows[x]) for x in letters for y in letters} if pairs else {})


def _likelihood(value: Column, language: Language) -> Column:
    """Mean logarithm of the chances of the letters of a value behind the letter before; that of even chances without pairs."""
    even = -math.log2(26)
    if not language.bigrams:
        return F.lit(even)
    chances = F.create_map(*(F.lit(x) for pair, chance in sorted(language.bigrams.items()) for x in (pair, chance)))
    lower = F.lower(value)
    pairs = F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: F.try_element_at(chances, F.substring(lower, i, F.lit(2))))
    known = F.filter(pairs, lambda p: p.isNotNull())
    return F.transform(F.array(known), lambda k: F.when(F.size(k) > 0, F.aggregate(k, F.lit(0.0), lambda a, x: a + x) / F.size(k)).otherwise(F.lit(even)))[0]


def _coverage(value: Column, language: Language) -> Column:
    """Share of a value that is words of the dictionary."""
    if not language.words:
        return F.lit(0.0)
    known = F.array(*(F.lit(w) for w in language.words))
    parts = F.filter(F.transform(F.regexp_extract_all(value, F.lit(_PIECE), F.lit(0)), F.lower), lambda p: F.array_contains(known, p))
    return F.length(F.array_join(parts, "")) / F.length(value)


def features(found: DataFrame, language: Language) -> DataFrame:
    """found with one column for each of FEATURES, from candidate, before, after and path."""
    value = F.col("candidate")
    classes = F.translate(value, "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 10 + "a" * 26 + "A" * 26)
    runs = F.length(F.regexp_replace(classes, "(.)\\1+", "$1"))
    part = lambda pattern: F.length(F.regexp_replace(value, pattern, "")) / F.length(value)
    return found.withColumns({
        "length": F.length(value).cast("double"),
        "likelihood": _likelihood(value, language),
        "changes": (runs - 1) / (F.length(value) - 1),
        "coverage": _coverage(value, language),
        "digits": part("[^0-9]"),
        "letters": part("[^A-Za-z]"),
        "mixed": (value.rlike("[a-z]") & value.rlike("[A-Z]")).cast("double"),
        "secret_near": _near("before", SECRET_WORDS),
        "harmless_near": _near("before", HARMLESS_WORDS),
        "secret_after": _near("after", SECRET_WORDS),
        "harmless_after": _near("after", HARMLESS_WORDS),
        "quoted": F.col("before").rlike("[\"'`]$").cast("double"),
        "assigned": F.col("before").rlike("[=:]\\s*[\"'`]?$").cast("double"),
        "harmless_path": _near("path", PATH_WORDS),
        "prefixed": value.rlike(f"^(?:{PREFIXES}|eyJ)").cast("double"),
    })


def labelled_findings(spark: SparkSession, rows: int = 4000, words: list[str] | None = None) -> DataFrame:
    """Findings with a label (1: a secret), made by rule from hashes: keys of several formats in code-like contexts, and
    the harmless values that look like them (numbers, checksums, identifiers, long words, placeholders).

    The long words are joined from 20 of words, spread over the list, or from PLAIN_WORDS."""
    plain_words = tuple(words[i * len(words) // 20] for i in range(20)) if words and len(words) >= 20 else PLAIN_WORDS
    base = spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("hex"), F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), F.col("id").cast("string")), 256))).alias("b64"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("x"), F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1_000_003)).alias("y"))
    choose = lambda options, by: F.element_at(F.array(*(F.lit(o) if isinstance(o, str) else o for o in options)), (F.pmod(by, F.lit(len(options))) + 1).cast("int"))
    size = (F.pmod(F.col("y"), F.lit(3)) * 8 + 24).cast("int")
    text = F.regexp_replace("b64", "[+/=]", "")
    secret = choose([F.substring("hex", 1, 40), F.substring("hex", F.lit(1), size), F.substring(text, F.lit(1), size), F.concat(F.lit("sk_live_"), F.substring(text, 1, 24)), F.concat(F.lit("ghp_"), F.substring(text, 1, 36)), F.concat(F.lit("AKIA"), F.upper(F.substring("hex", 1, 16))), F.col("b64"), F.concat(F.substring(text, 3, 6), choose(["!", "#", "9", "x4"], F.col("y")), F.substring("hex", 5, 2)), F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(text, "\\d", ""), 1, 30)), F.concat(F.lit("AKIA"), F.substring(F.upper(F.regexp_replace(text, "\\d", "")), 1, 16)), F.concat(F.lit("eyJ"), F.substring(text, 1, 20), F.lit("."), F.substring(text, 5, 24), F.lit("."), text)], F.col("x"))
    numbers = F.regexp_replace("hex", "[a-f]", "")
    join = choose(["-", "_", "/", ""], F.col("y"))
    some = [choose(list(plain_words[a:b]), by) for a, b, by in ((0, 12, F.col("x")), (6, 20, F.col("y")), (0, 20, F.col("x") + F.col("y")), (3, 17, F.col("x") * 3 + 1))]
    words = F.concat(some[0], join, some[1], join, some[2], join, some[3], join, some[0], F.pmod("y", F.lit(100)).cast("string"))
    uuid = F.regexp_replace(F.substring("hex", 1, 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    harmless = choose([F.rpad(F.substring(numbers, 1, 16), 16, "7"), F.substring("hex", 1, 40), words, uuid, words, F.rpad(F.substring(numbers, 1, 20), 18, "3"), F.substring("hex", 1, 32), F.concat(F.lit("1234567890"), choose(["abcdef", "1234567", "xxxxxxxx"], F.col("y"))), choose(list(PLACEHOLDERS), F.col("y"))], F.col("x"))
    secret_lead = F.concat(choose(["", "the ", "then let ", "export ", "in that. "], F.col("y")), choose(list(SECRET_WORDS), F.col("x") + F.col("y")), choose([" = \"", "=\"", ": \"", "=", " = '", ": "], F.col("x") * 7 + F.col("y")))
    plain = F.concat(choose(list(plain_words), F.col("y")), F.lit(" "), choose(list(plain_words), F.col("x")), F.lit(" "))
    harmless_lead = F.when(F.pmod("y", F.lit(2)) == 0, plain).otherwise(F.concat(choose(["", "the ", "see "], F.col("y")), choose(list(HARMLESS_WORDS), F.col("x") + F.col("y")), choose([" ", ": ", " = \"", "="], F.col("x") * 5 + F.col("y"))))
    secret_lead = F.when(F.pmod("x", F.lit(11)).isin(3, 4, 5, 8, 9, 10) & (F.pmod("y", F.lit(3)) > 0), plain).otherwise(secret_lead)
    label = F.pmod("id", F.lit(2)).cast("double")
    harmless_kind = F.when(F.pmod("x", F.lit(9)) == 8, secret_lead).when(F.pmod("x", F.lit(9)).isin(1, 6), F.concat(choose(list(HARMLESS_WORDS), F.col("y")), choose([" ", ": "], F.col("x")))).otherwise(harmless_lead)
    path = F.when((label == 0) & (F.pmod("y", F.lit(5)) == 0), choose(["tests/a", "docs/b", "example/c"], F.col("x"))).otherwise(choose(["src0", "src1", "app/main", "src17"], F.col("y")))
    tail = F.concat(choose(["\" ", "\"; ", "' ", " ", ", "], F.col("x") + 2), choose(list(plain_words), F.col("y") + 3), F.lit(" "))
    tail = F.when((label == 0) & (F.pmod("y", F.lit(6)) == 0), F.concat(tail, choose(list(HARMLESS_WORDS), F.col("x") + 1))).otherwise(F.concat(tail, choose(list(plain_words), F.col("x"))))
    return base.select(F.when(label == 1, secret).otherwise(harmless).alias("candidate"), F.when(label == 1, secret_lead).otherwise(harmless_kind).alias("before"), tail.alias("after"), path.alias("path"), label.alias("label"))


@dataclass
class Scanner:
    """A forest and the language that its features are read by; without a forest all scores are share."""

    language: Language
    forest: RandomForestClassificationModel | None
    share: float = 0.0


def fit(labelled: DataFrame, language: Language, trees: int = 20, depth: int = 8) -> Scanner:
    """A random forest over FEATURES from at most LABELLED_ROWS findings (candidate, before, after, path, label), chosen by hash.

    Null labels are left out. From findings of one label alone all scores are that label, from an empty table 0: there is
    nothing to tell apart.
    """
    key = ["candidate", "before", "after", "path", "label"]
    some = labelled.where("label IS NOT NULL").orderBy(F.xxhash64(*key), *key).limit(LABELLED_ROWS)
    kinds = {float(r["label"]) for r in some.select("label").distinct().collect()}
    if len(kinds) < 2:
        return Scanner(language, None, max(kinds, default=0.0))
    rows = features(some, language).select("label", *FEATURES)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return Scanner(language, RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt").fit(data))


def scan(docs: DataFrame, scanner: Scanner, path: str | None = "source") -> DataFrame:
    """A row per candidate of docs (doc_id, text, path): doc_id, place, kind, fingerprint, n_chars, score, is_secret.

    fingerprint is the SHA-256 of the candidate, so results hold no secrets. score is the forest's share of trees for
    a secret; is_secret if it is THRESHOLD or more. One map over the table, without a shuffle.

    Null and empty texts have no candidates; texts and candidates of any length are read whole. Null doc_id and path:
    kept, as empty path. Repeated rows: a result for each; equal findings get equal scores, and of alternatives at one
    place the first in CANDIDATE counts. Other columns are not read. An empty table gives an empty result.
    """
    found = features(findings(docs, path), scanner.language)
    if scanner.forest is None:
        scored, score = found, F.lit(scanner.share)
    else:
        scored = scanner.forest.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(found))
        score = F.round(vector_to_array("probability")[1], 6)
    value = F.col("candidate")
    kinds = (("aws", "^AKIA"), ("github", "^gh[pousr]_"), ("stripe", "^[sr]k_"), ("number", "^\\d+$"), ("uuid", "^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}"), ("hex", "^[0-9a-fA-F]+$"))
    kind = reduce(lambda rest, k: F.when(value.rlike(k[1]), k[0]).otherwise(rest), reversed(kinds), F.lit("text"))
    return scored.select("doc_id", "place", kind.alias("kind"), F.sha2(value, 256).alias("fingerprint"), F.length(value).cast("long").alias("n_chars"), score.alias("score"), (score >= THRESHOLD).alias("is_secret"))
