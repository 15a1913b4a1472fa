"""Leaked credentials in texts: candidates by shape, false positives removed by a random forest.

Everything that touches documents is SQL functions on one row: candidates and the text around them
are arrays, their features are expressions, and the trained forest is an expression too. Scanning
and redacting need no shuffle. The forest itself is trained on a bounded table of labelled findings.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideledger.llm.text import prepared

# At least 16 characters of a key's alphabet with a digit among them.
CANDIDATE = (
    "(?<![A-Za-z0-9_+/@-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}(?![A-Za-z0-9_+/@-])"
)
AROUND = 64
MASK = "[SECRET]"
THRESHOLD = 0.5
TREES, DEPTH, SEED = 15, 6, 17
LABELLED_ROWS = 3_000

# Words of common identifiers and of placeholders.
DICTIONARY = (
    "account address api application array balance base binary buffer build cache change channel "
    "class client code color column config connection content context control count create data "
    "date default delete demo device document domain download dummy element email end error event "
    "example export factory false field file filter first format function get group handler hash "
    "header height here home host html http https icon image index info input insert int item json "
    "key last layer layout length level library line link list load local lock log login main "
    "manager map master max message method min mode model module month name network next node "
    "null number object option order output package page param parent password path payment "
    "phone photo placeholder port process product profile project property query queue read "
    "record redacted release remove report request resource response result return role route row "
    "sample save schema screen script search secret select send server service session set size "
    "sort source start state static status stop store stream string style system table tag task "
    "template test text thread time title token total true type update upload url user util value "
    "version video view web width window word write year your"
).split()
ISSUERS = "^(AKIA|ASIA|gh[pousr]_|github_pat_|sk_live_|rk_live_|xox[abprs]-|AIza|glpat-|eyJ)"
NAMED = (
    "(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|auth(orization)?|bearer|credentials?|"
    "private[_-]?key|access[_-]?key)[\"'\\s]*(:|=|=>|:=|\\s)\\s*[\"']?$"
)
ASSIGNED = "[:=]\\s*[\"']?$"
BENIGN = (
    "(?i)(sha-?[0-9]*|md5|crc|checksum|digest|integrity|commit|revision|rev|hash|uuid|guid|isbn|"
    "etag|version|build|order|invoice|trace|request[_-]?id|example|placeholder|sample|dummy)"
    "\\W{1,4}(\\w+\\W{1,4})?$"
)
TEST_PATH = "(?i)(^|[/._-])(tests?|fixtures?|mocks?|examples?|samples?|docs?|vendor|locks?)([/._-]|$)"


def features(token: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    """What the forest sees of a finding: its form, its words, its path and its neighbours."""
    n = F.length(token)
    lower = F.lower(token)

    def share(pattern: str) -> Column:
        return F.regexp_count(token, F.lit(pattern)) / n

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("double")

    letters_only = F.regexp_replace(lower, "|".join(sorted(DICTIONARY, key=lambda w: -len(w))), "")
    return {
        "length": F.least(n, F.lit(200)).cast("double"),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "switches": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"),
        "hard_pairs": F.regexp_count(lower, F.lit("(?=[bcdfghjklmnpqrstvwxz]{3})")) / n,
        "variety": F.size(F.array_distinct(F.split(token, ""))) / F.least(n, F.lit(64)),
        "hex": flag(token.rlike("^[0-9a-fA-F]+$")),
        "grouped": share("[-_/]"),
        "slashes": share("/"),
        "words": 1 - F.length(letters_only) / n,
        "issuer": flag(token.rlike(ISSUERS)),
        "test_path": flag(path.rlike(TEST_PATH)),
        "named": flag(before.rlike(NAMED)),
        "assigned": flag(before.rlike(ASSIGNED)),
        "benign_before": flag(before.rlike(BENIGN)),
        "benign_after": flag(after.rlike("(?i)^\\W{0,4}(checksum|digest|commit|example|placeholder)")),
    }


def labelled_findings(spark: SparkSession, rows: int = LABELLED_ROWS) -> DataFrame:
    """Findings with a label: token, before, after, path, label (1: a secret).

    Drawn by rule from hashes of row numbers: credentials in the usual formats, and things that
    look like them (commit and file hashes, identifiers, paths, numbers, placeholders).
    """
    digest = F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string")), 256)
    mixed = F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "7")
    capital = F.upper(F.translate(digest, "0189", "gkmz"))
    word = F.element_at(F.array(*map(F.lit, DICTIONARY)), (F.col("id") % len(DICTIONARY) + 1).cast("int"))
    other = F.element_at(F.array(*map(F.lit, DICTIONARY)), (F.col("id") * 7 % len(DICTIONARY) + 1).cast("int"))
    prose = F.concat(F.lit("and "), word, F.lit(" of the "))
    some_digits = F.translate(F.substring(digest, 1, 20), "abcdef", "123456")
    kinds = [
        (F.concat(F.lit("AKIA"), F.substring(capital, 1, 16)), prose, "a/settings.py", 1),
        (F.concat(F.lit("AKIA"), F.substring(capital, 5, 16)), F.lit("access_key = \""), "", 1),
        (F.substring(digest, 1, 18), F.lit("in password="), "", 1),
        (F.substring(digest, 1, 40), F.lit("the token = \""), "src", 1),
        (F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), prose, "", 1),
        (F.concat(F.lit("sk_live_"), F.substring(mixed, 1, 24)), F.lit("api_key: "), "app", 1),
        (F.base64(F.unhex(digest)), F.lit("secret: '"), "deploy", 1),
        (F.substring(mixed, 1, 32), F.lit("auth_token="), "", 1),
        (F.substring(digest, 1, 40), F.lit("see commit "), "src", 0),
        (digest, F.lit("sha256: "), "", 0),
        (F.substring(digest, 1, 32), F.lit("md5 = "), "release", 0),
        (F.substring(digest, 1, 40), prose, "", 0),
        (F.regexp_replace(F.substring(digest, 1, 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit("id="), "", 0),
        (F.concat(word, F.initcap(other), F.lit("Controller"), F.substring(some_digits, 1, 2)), prose, "src", 0),
        (F.concat(F.lit("src/main/"), word, F.lit("/"), other, F.lit("2/"), word), prose, "", 0),
        (F.concat(word, F.lit("_"), other, F.lit("_value_"), F.substring(some_digits, 1, 1)), F.lit("key = "), "", 0),
        (some_digits, F.lit("order "), "", 0),
        (F.concat(F.lit("your_"), word, F.lit("_secret_here_1")), F.lit("secret = \""), "", 0),
        (F.concat(F.lit("xxxxxxxxxxxxxxxx"), F.substring(some_digits, 1, 4)), F.lit("token = \""), "", 0),
        (F.concat(F.lit("EXAMPLE_"), F.upper(word), F.lit("_KEY_12345678")), F.lit("password="), "docs/readme", 0),
        (F.substring(digest, 1, 32), F.lit("token = \""), "tests/fixtures/keys", 0),
        (F.concat(word, other, word, F.lit("2024")), prose, "", 0),
    ]
    kind = F.col("id") % len(kinds)
    token = before = path = label = F.lit(None)
    for i, (t, b, p, y) in enumerate(kinds):
        token = F.when(kind == i, t).otherwise(token)
        before = F.when(kind == i, b).otherwise(before)
        path = F.when(kind == i, F.lit(p)).otherwise(path)
        label = F.when(kind == i, F.lit(y)).otherwise(label)
    return spark.range(rows).select(
        "id", token.alias("token"), before.alias("before"), F.lit(" and").alias("after"),
        path.alias("path"), label.cast("double").alias("label"),
    ).where(F.length("token") >= 16)


def fit(findings: DataFrame) -> RandomForestClassificationModel:
    """Train the forest on findings(token, before, after, path, label)."""
    parts = features(*(F.col(c) for c in ("token", "before", "after", "path")))
    rows = findings.select("token", "before", "label", *(c.alias(n) for n, c in parts.items()))
    rows = VectorAssembler(inputCols=list(parts), outputCol="features").transform(rows)
    # One partition and a fixed order, so that the same findings give the same forest.
    rows = rows.repartition(1).sortWithinPartitions("token", "before", "label")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)


def vote(model_text: str, names: list[str], finding: Column) -> Column:
    """The share of trees that call a finding a secret, as an expression on its features."""
    trees: list[Column] = []
    lines = iter(model_text.splitlines())

    def node() -> Column:
        line = next(lines).strip()
        if found := re.match(r"Predict: ([\d.]+)", line):
            return F.lit(float(found[1]))
        index, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        next(lines)  # Else
        return F.when(finding[names[int(index)]] <= float(limit), low).otherwise(node())

    for line in lines:
        if line.strip().startswith("Tree "):
            trees.append(node())
    total = trees[0]
    for tree in trees[1:]:
        total = total + tree
    return total / len(trees)


def scanned(docs: DataFrame, text: str, path: str, model: RandomForestClassificationModel) -> DataFrame:
    """``docs`` with two more columns: __gaps, the text between candidates, and __findings."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    names = list(features(F.lit(""), F.lit(""), F.lit(""), F.lit("")))
    split = docs.withColumn(
        "__tokens",
        F.when(body.rlike(CANDIDATE), F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0))),
    ).withColumn("__gaps", F.when(F.col("__tokens").isNotNull(), F.split(body, CANDIDATE, -1)))

    def described(token: Column, i: Column) -> Column:
        before = F.substring(F.get("__gaps", i), -AROUND, AROUND)
        after = F.substring(F.get("__gaps", i + 1), 1, AROUND)
        parts = features(token, before, after, where)
        return F.struct(token.alias("token"), before.alias("before"), after.alias("after"),
                        *(c.alias(n) for n, c in parts.items()))

    return (
        split.withColumn("__parts", F.transform("__tokens", described))
        .withColumn(
            "__findings",
            F.transform("__parts", lambda f: F.struct(
                f["token"].alias("token"), f["before"].alias("before"), f["after"].alias("after"),
                vote(model.toDebugString, names, f).alias("probability"),
            )),
        )
        .drop("__tokens", "__parts")
    )


def secret_findings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    path: str = "source",
    findings: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each candidate: doc_id, finding_no (from 0, in order of the text), masked (first
    four characters and stars), length, sha256 of the candidate, probability, is_secret.

    Null and empty texts have no candidates. A null path counts as an empty one, a null id stays
    null, and repeated rows give repeated findings. ``findings`` are labelled findings to learn
    from; by default those of ``labelled_findings``.
    """
    prepared(docs.sparkSession)
    model = fit(findings if findings is not None else labelled_findings(docs.sparkSession))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.col(path).alias("path"))
    rows = scanned(own, "text", "path", model).select("doc_id", F.posexplode("__findings").alias("no", "f"))
    token = F.col("f.token")
    return rows.select(
        "doc_id",
        F.col("no").cast("long").alias("finding_no"),
        F.rpad(F.substring(token, 1, 4), 12, "*").alias("masked"),
        F.length(token).cast("long").alias("length"),
        F.sha2(token, 256).alias("sha256"),
        F.col("f.probability").alias("probability"),
        (F.col("f.probability") >= threshold).alias("is_secret"),
    )


def redacted(
    docs: DataFrame,
    text: str = "text",
    path: str = "source",
    findings: DataFrame | None = None,
    threshold: float = THRESHOLD,
    mask: str = MASK,
) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mask``; rows and columns stay the same.

    Texts without a secret, null ones too, are left as they are.
    """
    prepared(docs.sparkSession)
    model = fit(findings if findings is not None else labelled_findings(docs.sparkSession))
    rows = scanned(docs, text, path, model)
    token = F.transform(
        "__findings",
        lambda f: F.when(f["probability"] >= threshold, F.lit(mask)).otherwise(f["token"]),
    )
    clean = rows.withColumn("__tokens", token).withColumn(
        "__clean",
        F.array_join(
            F.transform("__gaps", lambda gap, i: F.concat(gap, F.coalesce(F.get("__tokens", i), F.lit("")))),
            "",
        ),
    )
    return clean.select(
        *(F.coalesce("__clean", text).alias(c) if c == text else F.col(c) for c in docs.columns)
    )
