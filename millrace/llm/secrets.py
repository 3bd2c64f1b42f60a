"""Secret scan: patterns find candidates, a random forest removes false positives. DataFrame operations only.

The forest sees the length of a candidate, how its characters change from class to class, how much of it dictionary words cover, the path it was found
under and the words beside it. It is trained from labelled findings; where nobody has labelled any, :func:`rule_labels` labels those of the
clear forms (known token formats, assignments to credential names that are quoted or look like tokens; plain numbers and candidates without any credential context).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Findings of each label that the forest is trained on at most, about, chosen by hash.
ROWS_PER_LABEL = 8000
TREES, DEPTH, SEED = 30, 6, 7
ACCEPTED = 0.5
MASK = "<SECRET>"
#: Code points before and after a candidate in which neighbouring words are looked for.
BESIDE = 40

#: Formats of well-known tokens. Fixed values.
FORMATS = {
    "aws": r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "google": r"AIza[0-9A-Za-z_-]{35}",
    "stripe": r"[sr]k_live_[A-Za-z0-9]{16,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}",
    # the whole block up to its end; without one, the lines of key text behind its head
    "pem": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:(?:[^-]*+-(?!----)){0,8}[^-]*+-----END [A-Z ]{0,20}PRIVATE KEY-----|(?:\s++[A-Za-z0-9+/=]{16,}+){0,200}+)",
}
_FORMAT = "|".join(FORMATS.values())
_BODY = "A-Za-z0-9+/_.-"
#: Anything else of 16 or more token characters with a digit among them, up to a known format; never a name with the = behind it, so that the name stands before the value.
GENERIC = rf"(?<![{_BODY}])(?=[A-Za-z+/_.-]*+[0-9])(?:(?!{_FORMAT})[{_BODY}]){{16,}}+(?!=+[{_BODY}])=*+"
_NAME = r"(?i:token|secret|passw(?:or)?d|passphrase|pwd|api[ _-]?key|access[ _-]?key|auth|bearer|private|credential|signature)(?:s|[_-][A-Za-z0-9_-]{0,60}|[A-Z][A-Za-z0-9]{0,60}(?<!OR)|[0-9]{1,3})?"
_TO = r"[\"'`]?\s{0,3}(?:=>?|:=?)"
_BARE = r"(?:[^\s\"'`,;&<>()\[\]{}]|&(?![\w.%-]+=))"
#: Six or more printable characters assigned to a credential name: all between quotes; without quotes up to a blank or separator, behind a blank only with a digit, as
#: prose and code assign plain words there. The short look behind comes first, as the long one costs more.
ASSIGNED = "|".join([
    *[rf"(?<={q})(?<={_NAME}{_TO}\s{{0,3}}{q})(?:\\[^\r\n]|[^{q}\\\r\n]){{6,}}+(?={q})" for q in "\"'`"],
    rf"(?<=[=:])(?<={_NAME}{_TO}){_BARE}{{6,}}+",
    rf"(?<=[=:]\s{{1,3}})(?<={_NAME}{_TO}\s{{1,3}})(?=[^\s0-9]*+[0-9]){_BARE}{{6,}}+",
])
CANDIDATE = f"{_FORMAT}|{ASSIGNED}|{GENERIC}"

#: Words whose share of a candidate is its dictionary coverage. Fixed values.
DICTIONARY = [
    "access", "account", "address", "admin", "agent", "amazon", "android", "apple", "application", "archive", "article", "asset", "author", "backup", "blog",
    "bucket", "build", "button", "cache", "category", "center", "change", "channel", "chapter", "class", "client", "cloud", "code", "color", "comment", "common",
    "community", "config", "connect", "content", "control", "copy", "count", "country", "data", "database", "date", "default", "delete", "demo", "design", "detail",
    "device", "digital", "document", "domain", "download", "edit", "email", "engine", "error", "event", "example", "export", "feature", "field", "file", "filter",
    "folder", "font", "form", "forum", "frame", "function", "game", "group", "guide", "header", "health", "help", "history", "home", "host", "html",
    "http", "image", "import", "index", "info", "input", "install", "internet", "issue", "item", "java", "key", "label", "language", "layout", "length",
    "letter", "library", "license", "link", "linux", "list", "local", "login", "mail", "main", "manager", "market", "media", "member", "menu", "message",
    "method", "mobile", "model", "module", "music", "name", "network", "news", "node", "number", "object", "office", "online", "option", "order", "output",
    "package", "page", "parameter", "password", "path", "people", "photo", "place", "player", "plugin", "point", "policy", "post", "power", "press", "price",
    "private", "process", "product", "profile", "program", "project", "property", "public", "python", "query", "question", "random", "read", "record", "release", "report",
    "request", "resource", "response", "result", "review", "root", "sample", "script", "search", "secret", "section", "security", "server", "service", "session", "setting",
    "source", "state", "status", "store", "string", "style", "support", "system", "table", "test", "text", "theme", "time", "title", "token", "update",
]

CREDENTIAL = r"(?:token|secret|passw(?:or)?d|passphrase|pwd|api[ _-]?key|access[ _-]?key|auth|bearer|private|credential|signature)"
PLAIN = r"(?:card|phone|call|number|isbn|iban|order|invoice|commit|sha|md5|digest|checksum|uuid|hash|version|page|date|http|www)"
DUMMY = r"(?:example|sample|dummy|test|fake|placeholder|change[ _-]?me|xxx|your)"
FEATURES = [
    "length", "letter_digit", "digit_letter", "case_changes", "same_class", "digits", "capitals", "hex", "symbols", "different", "dictionary",
    "known_format", "path_depth", "path_test", "path_config", "credential_before", "plain_before", "dummy_near", "assigned", "quoted", "word_beside",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: id, text_hash, path, ``start`` and ``n_chars`` in code points, ``value``, ``before`` and ``after``.

    Candidates are known formats anywhere, six or more printable characters assigned to a credential name (without quotes and behind a blank: with a digit among them),
    and elsewhere 16 or more token characters with a digit among them. A name may go on for 60 characters behind its credential word, as a look behind needs an end. A
    private key is one candidate from its head to its end; where the end is missing, with up to 200 lines of key text.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), path.alias("path"), F.col(text_col).alias("text"))
    # most texts hold none and go no further than this
    some = texts.filter(F.col("text").rlike(CANDIDATE))
    cut = some.select("id", "text_hash", "path", F.split("text", CANDIDATE, -1).alias("around"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["around"])
        return F.struct((start + F.length(pair["values"])).alias("at"), F.concat(state["starts"], F.array(start)).alias("starts"))

    # the pieces between candidates are one more than the candidates
    pairs = F.filter(F.arrays_zip("around", "values"), lambda p: p["values"].isNotNull())
    placed = cut.withColumn("starts", F.aggregate(pairs, zero, step)["starts"])
    # all that a candidate needs stands in one array, so that nothing is made anew for each
    behind = F.slice("around", F.lit(2), F.size("values"))
    zipped = F.arrays_zip("values", "starts", F.slice("around", F.lit(1), F.size("values")).alias("ahead"), behind.alias("behind"))
    rows = F.transform(
        zipped,
        lambda z: F.struct(
            z["starts"].alias("start"), F.length(z["values"]).cast("bigint").alias("n_chars"), z["values"].alias("value"),
            F.right(z["ahead"], F.lit(BESIDE)).alias("before"), F.left(z["behind"], F.lit(BESIDE)).alias("after"),
        ),
    )
    # not a plain explode: it would be tested for rows below, by making them twice
    return placed.select("id", "text_hash", "path", F.explode_outer(rows).alias("c")).filter("c is not null").select("id", "text_hash", "path", "c.*")


def described(found: DataFrame) -> DataFrame:
    """``found`` with ``kind`` and the features of the forest."""
    v, low = F.col("value"), F.lower("value")
    n = F.length(v)
    count = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    flag = lambda c: c.cast("double")
    before, after, path = F.lower("before"), F.lower("after"), F.lower("path")
    kind = F.coalesce(*[F.when(v.rlike(p), F.lit(name)) for name, p in FORMATS.items()], F.lit("generic"))
    return found.withColumn("kind", kind).withColumns({
        "length": n.cast("double"),
        "letter_digit": count("(?<=[A-Za-z])(?=[0-9])"),
        "digit_letter": count("(?<=[0-9])(?=[A-Za-z])"),
        "case_changes": count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "same_class": count("(?<=[A-Za-z])(?=[A-Za-z])|(?<=[0-9])(?=[0-9])"),
        "digits": count("[0-9]"),
        "capitals": count("[A-Z]"),
        "hex": count("[0-9A-Fa-f]"),
        "symbols": count("[^0-9A-Za-z]"),
        "different": F.size(F.array_distinct(F.split(v, ""))) / n,
        "dictionary": 1 - F.length(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")) / n,
        "known_format": flag(F.col("kind") != "generic"),
        "path_depth": F.regexp_count(path, F.lit("/")).cast("double"),
        "path_test": flag(path.rlike("test|example|sample|fixture|doc|mock")),
        "path_config": flag(path.rlike(r"\.(env|ini|cfg|conf|ya?ml|json|properties|toml|sh)$|config|secret|credential")),
        "credential_before": flag(before.rlike(CREDENTIAL)),
        "plain_before": flag(before.rlike(PLAIN)),
        # a long key may spell such a word by chance
        "dummy_near": flag(F.concat_ws(" ", before, F.when(F.col("kind") == "pem", "").otherwise(low), after).rlike(DUMMY)),
        "assigned": flag(before.rlike(r"(?:=>?|:=?)\s*[\"'`]?$")),
        "quoted": flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "word_beside": flag(before.rlike(r"\p{L}\s$") & after.rlike(r"^[\s,.]+\p{L}")),
    })


def rule_labels(findings: DataFrame) -> DataFrame:
    """``findings`` with ``label``: 1 for clear secrets, 0 for clear false positives, null for the rest, which the forest decides."""
    # without quotes, as in shells, .env files and URLs, the value has to look like a token itself: no path, number or identifier
    token = F.col("value").rlike("^[A-Za-z0-9+/_-]+=*$") & (F.col("digits") > 0) & (F.col("digits") < 1) & (F.col("dictionary") < 0.2)
    token = token & (F.col("length") >= 16)
    # a quoted word may be a password or the name of something: the forest decides
    mixed = F.col("value").rlike("^[^\\s]*[0-9][^\\s]*$") & (F.col("digits") < 1) | (F.col("digits") == 1) & (F.col("length") >= 16)
    real = (F.col("known_format") == 1) | ((F.col("credential_before") == 1) & (F.col("assigned") == 1) & ((F.col("quoted") == 1) & mixed | token))
    named_plain = (F.col("plain_before") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 0)
    plain = (F.col("digits") == 1) | ((F.col("credential_before") == 0) & ((F.col("assigned") == 0) | named_plain))
    label = F.when(F.col("dummy_near") == 1, 0).when(real, 1).when(plain, 0)
    return findings.withColumn("label", label.cast("double"))


def train(findings: DataFrame, label_col: str = "label", per_label: int = ROWS_PER_LABEL) -> RandomForestClassificationModel | float:
    """A forest from described findings with a label of 0 or 1; null labels are left out. With labels of one kind only, that label; without any, 0."""
    labelled = findings.filter(F.col(label_col).isin(0, 1)).withColumn("label", F.col(label_col).cast("double"))
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return next(iter(counts), 0.0)
    share = F.when(F.col("label") == 1, F.lit(min(1.0, per_label / counts[1.0]))).otherwise(F.lit(min(1.0, per_label / counts[0.0])))
    spot = F.pmod(F.xxhash64(F.lit("findings"), "value", "before", "after", "id", "start"), F.lit(1_000_003)) / 1_000_003
    # about twice per_label rows; in one order, so that reruns draw the same trees
    rows = labelled.filter(spot < share).select("label", *FEATURES).coalesce(1).sortWithinPartitions("label", *FEATURES)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(assembled(rows).select("label", "features"))


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def judged(findings: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """``findings`` with ``score``, the forest's probability that a finding is a secret."""
    if isinstance(model, float):
        return findings.withColumn("score", F.lit(model))
    scored = model.setProbabilityCol("probability").transform(assembled(findings))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row per secret: ``id_col``, ``text_hash``, ``start``, ``n_chars``, ``kind``, ``value``, ``score``.

    ``labelled`` are findings as :func:`candidates` gives them, with a ``label``; without it the findings in ``docs`` are labelled by rule. Null and empty texts hold
    nothing, a null path is empty, null ids are kept, a row that is given twice gives its findings twice. An empty table gives no row; other columns are not read.
    """
    found = cut_lineage(described(candidates(docs, id_col, text_col, path_col)), "findings")
    model = train(rule_labels(found) if labelled is None else described(labelled))
    kept = judged(found, model).filter(F.col("score") >= ACCEPTED)
    return kept.select(F.col("id").alias(id_col), "text_hash", "start", "n_chars", "kind", "value", "score")


def redact(docs: DataFrame, secrets: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every finding of :func:`scan` replaced by ``mask``; all rows and columns stay."""
    # a document has at most as many findings as characters
    spans = secrets.groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.sort_array(F.collect_set(F.struct("start", "n_chars"))).alias("__spans")
    )
    text = F.col(text_col)
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        piece = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.struct((span["start"] + span["n_chars"]).alias("at"), F.concat(state["out"], piece, F.lit(mask)).alias("out"))

    folded = F.aggregate("__spans", zero, step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    joined = docs.join(spans, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash")), "left")
    return joined.withColumn(text_col, F.when(F.col("__spans").isNull(), text).otherwise(folded)).select(*docs.columns)
