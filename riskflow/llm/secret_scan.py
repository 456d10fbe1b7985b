"""Secret scans: candidate strings, and a random forest that removes false positives.

DataFrame functions and MLlib only. Candidates are passwords in URLs, tokens of
several parts, values assigned by ``:`` or ``=``, and long runs of key
characters. The forest sees the candidate's length, its character transitions
and classes, how much of it dictionary words cover, the path (source) it came
from and the neighbouring words (those of the labelled findings' NEAR_WORDS most
frequent ones that stand before it). The dictionary is the table's own: the
DICTIONARY_WORDS words that most documents hold.

The forest is trained on labelled findings (doc_id, start, label). Where none
are given, findings are labelled by rule (``label_by_rule``) from what the forest
does not see: formats of well-known credentials, the punctuation around a
candidate, lists of telling words and placeholders. So the forest does not get
the rule's own columns: it has to find what the labelled strings and their
surroundings have in common, and decides for all other findings by it. Strings
of a well-known format count as secrets whatever the forest says. Training uses
at most ``max_findings`` findings of each label in a fixed hash order.

Defined cases: null and empty texts have no findings; a null source counts as
empty; rows that repeat an id and text are scanned once; without findings of
both labels the rule itself decides (score 1 or 0); an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskflow.session import materialize

# In this order: the password of a URL, a token of several parts, a value after ":" or "=" (but not a URL's host or port),
# a long run of key characters.
# Long looks back come after a one-character look, and runs that can't end elsewhere are possessive.
CANDIDATE = (r"""(?<=:)(?<=://[^\s/:@"']{0,64}:)[^\s/:@"']{4,}+(?=@)"""
             r"""|(?<![A-Za-z0-9+/_=\-.])[A-Za-z0-9_\-]{10,}+(?:\.[A-Za-z0-9_\-]{10,}+){1,3}(?![A-Za-z0-9_\-.])"""
             r"""|(?<=[:=]\s{0,2}["']?)(?<!://[^\s/]{0,128}:)(?!//|[A-Za-z][A-Za-z0-9+.\-]*://)[^\s"',;]{8,}"""
             r"""|(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_\-]{16,}={0,2}""")
MARK = "[SECRET]"
MAX_FINDINGS = 10_000
TREES, DEPTH, SEED = 40, 10, 17
NEAR_COUNT = 6  # so many words before a candidate
NEAR_CHARS = 48  # neighbouring words are looked for this far to the left
AFTER_CHARS = 8  # and the text this far to the right; no candidate is shorter
REACH = NEAR_CHARS // 8  # so many candidates before one hold NEAR_CHARS together

# Formats of well-known credentials and words around (no) secrets.
ASSIGNED = r"""[:=]\s*["']?$"""
TO_LAST = r"""^["']?[ \t]*([:=]\s*)?["']?$"""  # all that stands between a name and its value
KNOWN_FORMAT = (r"^(eyJ[A-Za-z0-9_\-]{8,}(\.[A-Za-z0-9_\-]{8,}){2}|(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_\-]{20,}"
                r"|xox[baprs]-[A-Za-z0-9\-]{10,}|glpat-[A-Za-z0-9_\-]{20}|AIza[A-Za-z0-9_\-]{35})$")
SECRET_WORDS = r"(?i)(secret|token|passw(or)?d|passwd|pwd|api.?key|access.?key|bearer|credential|private|auth)"
HARMLESS_WORDS = r"(?i)(sha-?(1|256|512)|md5|commit|checksum|digest|hash|uuid|guid|isbn|card|phone|etag|integrity)"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|your[_\-]?|xxxx|1234567|<|>|\$\{|\*\*\*)"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|doc)"
URL_PASSWORD = r"""://[^\s/:@"']{0,64}:$"""
DICTIONARY_WORDS = 1_000
NEAR_WORDS = 200
_LETTERS = r"[a-z]{4,16}"

FEATURES = ["length", "changes", "digits", "uppers", "symbols", "hexadecimal", "distinct_chars", "syllables", "dictionary",
            "test_path", "path_depth"]
CONTEXT = ["assigned", "secret_near", "harmless_near", "placeholder", "known_format", "url_password", "all_digits"]


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The words (4 to 16 letters) that most documents hold, ties in alphabetical order; only they pass the driver."""
    held = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<![a-z0-9]){_LETTERS}(?![a-z0-9])"),
                                                                       F.lit(0)))).alias("word"))
    found = held.groupBy("word").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.col("n").desc(), "word").limit(words)
    return [r["word"] for r in found.collect()]


def _share(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, pattern, "")) / F.length(c)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, nth, start (code points), the candidate, the text around it and its neighbouring words.

    The words are those since the candidate before; an assigned candidate's also go further left, as its name can be a
    candidate of its own, up to the last assigned value.
    """
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text", "coalesce(source, '') source").where("text is not null")
    found = docs.where(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("cands"), F.split("text", CANDIDATE, -1).alias("parts"))
    # The text is part 0, candidate 0, part 1, ... Other candidates count as text around a candidate: the last NEAR_CHARS
    # before it lie in its own part and the REACH pairs of part and candidate before that.
    found = found.withColumn("pairs", F.arrays_zip(F.col("parts").alias("part"), F.col("cands").alias("cand")))

    def around(pair, nth):
        earlier, after = F.greatest(nth - REACH, F.lit(0)), F.get("pairs", nth + 1)
        return F.struct(
            pair["cand"].alias("cand"), F.length(pair["part"]).alias("gap"), F.right(pair["part"], F.lit(NEAR_CHARS)).alias("own"),
            F.transform(F.slice("pairs", earlier + 1, nth - earlier), lambda f: F.struct(
                F.right(f["part"], F.lit(NEAR_CHARS)).alias("part"), F.right(f["cand"], F.lit(NEAR_CHARS)).alias("cand"))).alias("pairs"),
            F.left(F.concat(after["part"], F.coalesce(after["cand"], F.lit(""))), F.lit(AFTER_CHARS)).alias("after"))

    def text_of(pairs):
        return F.aggregate(pairs, F.lit(""), lambda out, f: F.concat(out, f["part"], f["cand"]))

    # An assigned value ends the words that can name the next one, unless the next is assigned to it.
    since_value = F.aggregate("pairs", F.lit(""), lambda out, f: F.when(
        F.concat(out, f["part"]).rlike(ASSIGNED), "").otherwise(F.concat(out, f["part"], f["cand"])))
    own, before = F.col("own"), F.right(F.concat(text_of("pairs"), F.col("own")), F.lit(NEAR_CHARS))
    to_last = F.when((F.col("since") == "") & own.rlike(TO_LAST), F.get("pairs", F.size("pairs") - 1)["cand"])
    words = F.right(F.concat("since", F.coalesce(to_last, F.lit("")), own), F.lit(NEAR_CHARS))
    each = (found.select("doc_id", "source", "text_hash", F.posexplode(F.transform(
                F.slice("pairs", F.lit(1), F.size("cands")), around)).alias("nth", "f"))
            .select("doc_id", "source", "text_hash", "nth", "f.*")
            .withColumns({"before": before, "since": since_value})
            .withColumn("words", F.when(F.col("before").rlike(ASSIGNED), words).otherwise(own))
            .drop("pairs", "own", "since"))
    each = each.dropDuplicates(["doc_id", "text_hash", "nth"])
    so_far = Window.partitionBy("doc_id", "text_hash").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    return each.withColumn("start", F.sum(F.col("gap") + F.length("cand")).over(so_far) - F.length("cand"))


def with_features(found: DataFrame, known_words: list[str]) -> DataFrame:
    """The candidates with the numbers that the forest sees (FEATURES), the words before them, and those of the rule (CONTEXT)."""
    c, low = F.col("cand"), F.lower("cand")
    changes = F.regexp_count(c, F.lit(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
                                      r"|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"))
    before, words = F.col("before"), F.col("words")
    covered = 1 - _share(low, "|".join(sorted(known_words, key=lambda w: (-len(w), w)))) if known_words else F.lit(0.0)
    numbers = {
        "length": F.log1p(F.length(c)),
        "changes": changes / F.length(c),
        "digits": _share(c, "[^0-9]"),
        "uppers": _share(c, "[^A-Z]"),
        "symbols": _share(c, "[A-Za-z0-9]"),
        "hexadecimal": c.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "distinct_chars": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "syllables": F.regexp_count(low, F.lit("[bcdfghj-np-tv-z][aeiouy]")) / F.length(c),
        "dictionary": covered,
        "test_path": F.col("source").rlike(TEST_PATH),
        "path_depth": F.regexp_count(F.col("source"), F.lit("/")),
        "assigned": before.rlike(ASSIGNED),
        "secret_near": words.rlike(SECRET_WORDS),
        "harmless_near": words.rlike(HARMLESS_WORDS),
        "placeholder": c.rlike(PLACEHOLDER),
        "known_format": c.rlike(KNOWN_FORMAT),
        "url_password": before.rlike(URL_PASSWORD),
        "all_digits": c.rlike("^[0-9]+$"),
    }
    near = F.filter(F.split(F.lower(F.regexp_replace("words", "(?<=[a-z])(?=[A-Z])", " ")), "[^a-z]+"), lambda w: F.length(w) > 1)
    return found.select("*", *[F.coalesce(numbers[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES + CONTEXT],
                        F.slice(F.reverse(near), 1, NEAR_COUNT).alias("near_words"))


def label_by_rule() -> Column:
    """1 for findings that format and context prove, 0 for harmless ones, null for the rest; from CONTEXT columns alone."""
    holds = {c: F.col(c) == 1 for c in CONTEXT}
    named = holds["secret_near"] & holds["assigned"] & ~holds["harmless_near"]
    is_key = (holds["known_format"] | holds["url_password"] | named) & ~holds["placeholder"] & ~holds["all_digits"]
    harmless = (holds["placeholder"] | holds["harmless_near"] | holds["all_digits"]
                | ~(holds["secret_near"] | holds["assigned"] | holds["known_format"]))
    return F.when(is_key, 1.0).when(harmless, 0.0)


def train(labelled: DataFrame, max_findings: int = MAX_FINDINGS):
    """Words model and forest over findings with features and a ``label`` (0 or 1); None without both labels."""
    order = F.xxhash64("cand", "before", "nth")
    parts = [labelled.where(F.col("label") == v).orderBy(order, "doc_id", "text_hash", "nth").limit(max_findings)
             for v in (0.0, 1.0)]
    sample = materialize(parts[0].unionByName(parts[1]).select("label", "near_words", *FEATURES).coalesce(1), "labelled-findings")
    if sample.select("label").distinct().count() < 2:
        return None
    stages = []
    if not sample.where(F.size("near_words") > 0).isEmpty():
        stages.append(CountVectorizer(inputCol="near_words", outputCol="near_counts", vocabSize=NEAR_WORDS, binary=True))
    stages.append(VectorAssembler(inputCols=FEATURES + (["near_counts"] if stages else []), outputCol="forest_input"))
    stages.append(RandomForestClassifier(featuresCol="forest_input", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                         featureSubsetStrategy="onethird", seed=SEED))
    return Pipeline(stages=stages).fit(sample)


def scored(found: DataFrame, forest) -> DataFrame:
    """The findings with score (0 to 1) and is_secret."""
    if forest is None:
        out = found.withColumn("score", F.coalesce(label_by_rule(), F.lit(0.0)))
    else:
        out = forest.transform(found).withColumn("score", vector_to_array("probability")[1])
        proven = (F.col("known_format") == 1) & (F.col("placeholder") == 0)
        out = out.withColumn("score", F.when(proven, 1.0).otherwise(F.col("score")))
    return out.withColumn("is_secret", F.col("score") >= 0.5)


def findings(docs: DataFrame, labelled: DataFrame | None = None, max_findings: int = MAX_FINDINGS) -> DataFrame:
    """Scored findings of all documents; the candidates are written once.

    ``labelled``: (doc_id, start, label) of findings known to be secrets (1) or harmless (0).
    """
    found = materialize(with_features(candidates(docs), dictionary(docs)), "candidates")
    if labelled is None:
        known = found.withColumn("label", label_by_rule()).where("label is not null")
    else:
        of = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("start").cast("long").alias("start"),
                             F.col("label").cast("double").alias("label")).distinct()
        known = found.join(of, ["doc_id", "start"])
    return scored(found, train(known, max_findings))


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark (and n_chars renewed where present)."""
    spans = (findings(docs, **options).where("is_secret").groupBy("doc_id", "text_hash")
             .agg(F.array_sort(F.collect_list(F.struct("start", F.length("cand").alias("size")))).alias("spans")))
    spans = materialize(spans, "secret-spans")
    text = docs["text"]
    here = F.xxhash64(text)
    clean = F.aggregate(
        spans["spans"], F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            (s["start"] + s["size"]).alias("at"),
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                     F.lit(MARK)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    clean = F.when(spans["spans"].isNull(), text).otherwise(clean)
    joined = docs.join(spans, docs["doc_id"].cast("long").eqNullSafe(spans["doc_id"]) & (here == spans["text_hash"]), "left")
    new = {"text": clean, "n_chars": F.when(spans["spans"].isNull(), docs["n_chars"]).otherwise(F.length(clean).cast(
        docs.schema["n_chars"].dataType))} if "n_chars" in docs.columns else {"text": clean}
    return joined.select(*[new.get(c, docs[c]).alias(c) for c in docs.columns])
