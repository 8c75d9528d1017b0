"""Secret scans: candidates found by one expression, false positives removed by a random forest. DataFrame functions only.

A candidate is a run of at least 12 key characters with a digit; where a known prefix begins it or a key word is set to it
(``=`` or ``:``), no digit is needed, and after such a word 6 characters do, marks between them included; so are the
password of an address and a private key in PEM form. Its features are its length, character transitions, shares of digits and capitals, distinct characters, dictionary coverage, whether it is part of a path, known prefixes,
and the words beside it (at most 40 characters before it). The forest is trained on labelled findings: lines with one candidate and a label, either given
as a table (``text``, ``label``) or made by a rule that imitates the common kinds of keys and look-alikes. Its trees
become CASE expressions, so that scoring stays in the JVM; a text is read once and never leaves its row.

Defined results: an empty table gives an empty result; a null text gives no candidates and stays null; texts of any length are scanned whole; repeated rows
are scanned each; columns named like added ones are replaced, all others stay as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, packed, unpacked

# Fixed values of this operator.
KEY_NAMES = "password|passwd|pwd|token|secret|api[_ -]?key|access[_ -]?key|auth|bearer|credential|private"
PREFIX = "AKIA|ASIA|ghp_|gho_|glpat-|sk_live|sk-|xox[bp]-|AIza|eyJ"
# A value set to a key word: key characters, and marks between them; "&" only where no other setting follows.
SET_VALUE = r"(?:[A-Za-z0-9_+/-]|[!@#$%^*.~?](?=[A-Za-z0-9])|&(?=[A-Za-z0-9])(?![A-Za-z_]+=)){6,}"
CANDIDATE = (  # one character is looked back at before many are
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,20}PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/=]{40,})*)"
    rf"|(?<=[=:\"' ])(?<=[=:][\"' ]{{0,3}})(?<![A-Za-z0-9_+/-])(?<=(?i:{KEY_NAMES})[\"' ]{{0,2}}[=:][\"' ]{{0,3}}){SET_VALUE}"
    r"|(?<=:)(?<=://[^\s/:@]{1,36}:)[^\s/:@]{4,}(?=@)"
    r"|(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{12,}|(?<=[=])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{12,}"
    rf"|(?<![A-Za-z0-9_+/-])(?={PREFIX})[A-Za-z0-9_+/-]{{12,}}"
)
KEY_WORDS = rf"(?i)(({KEY_NAMES})\W{{0,6}}|://[^\s/:@]+:)$"
OTHER_WORDS = r"(?i)(commit|sha1|sha256|sha512|md5|uuid|guid|hash|checksum|digest|revision|isbn|order|invoice|version|build|etag)\W{0,6}$"
PREFIXES = rf"^({PREFIX}|-----BEGIN)"
DICTIONARY = (
    "about access account admin article backup build cache class client code common config content core data date default dist "
    "document example error event factory file filter format from handler header helper image index input item library line link list "
    "local login main manager message model module name node number object option order output package page path port process product "
    "profile project python query read record release report request resource response result route sample script search server "
    "service session setting source state static status store string style system table template test text time type update user "
    "value version view width with word your"
).split()
FEATURES = ["length", "changes", "digits", "capitals", "distinct", "covered", "path", "prefixed", "keyed", "other", "hexadecimal", "separators"]
CLASS_CHANGE = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"


def features(value, before, after):
    size = F.length(value)

    def share(pattern: str):
        return (size - F.length(F.regexp_replace(value, pattern, ""))) / size

    beside = F.substring(before, -40, 40)
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return F.struct(
        size.cast("double").alias("length"),
        ((F.size(F.split(value, CLASS_CHANGE)) - 1) / size).alias("changes"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"),
        (F.size(F.array_distinct(F.split(value, "(?!^)"))) / F.least(size, F.lit(36))).alias("distinct"),
        share("(?i)(" + "|".join(DICTIONARY) + ")").alias("covered"),
        flag(beside.rlike(r"[/\\.]$") | value.rlike(r"/.*/") | F.substring(after, 1, 2).rlike(r"^([/\\]|\.[a-z])")).alias("path"),
        flag(value.rlike(PREFIXES)).alias("prefixed"),
        flag(beside.rlike(KEY_WORDS)).alias("keyed"),
        flag(beside.rlike(OTHER_WORDS)).alias("other"),
        flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hexadecimal"),
        share("[_+/-]").alias("separators"),
    )


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_found``, the candidates, ``_between``, the texts around them, and ``_features``; empty for null texts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_found", F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0)))
    df = df.withColumn("_between", F.when(F.size("_found") > 0, F.split(whole, CANDIDATE, -1)).otherwise(F.array(whole)))
    between = F.col("_between")
    return df.withColumn("_features", F.transform("_found", lambda v, k: features(v, between[k], between[k + 1])))


def labelled_findings(spark: SparkSession, rows: int = 4200, first: int = 0) -> DataFrame:
    """(text, label, kind) of lines with a candidate each, made by a rule from hashes of their numbers (from ``first`` on),
    labelled 1 for keys and 0 for look-alikes."""
    key = "sha2(cast(id as string), 256)"
    caps = f"translate(upper(substr({key}, 1, 16)), '018', 'QWZ')"
    mixed = f"translate(base64(unhex(substr({key}, 1, 48))), '=', '')"
    word = "element_at(split('the of report in und le para with notes and page', ' '), cast(1 + id div 20 % 11 as int))"
    pick = lambda of, at: f"element_at(split('{of}', ' '), cast(1 + conv(substr({key}, {at}, 3), 16, 10) % {len(of.split())} as int))"
    nouns = "correct horse battery staple window river purple castle garden thunder monkey silver orange planet basket"
    phrase = "concat_ws('-', " + ", ".join(pick(nouns, at) for at in (1, 5, 9, 13)) + ")"
    plain = pick("required optional incorrect forgotten disabled protected invalid changed expired missing something everything nothing default", 1)
    parts_of_names = "Abstract Bean Proxy Visitor Builder Observer Stream Worker Thread Socket Cursor Buffer Parser Lexer Token Vector Matrix Engine Bridge Adapter"
    camel = "concat(" + ", ".join(pick(parts_of_names, at) for at in (1, 5, 9)) + ")"
    kinds = [
        (1, f"concat('token = \"', substr({key}, 1, 40), '\"')"),
        (1, f"concat('AKIA', {caps})"),
        (1, f"concat('password=', substr({key}, 1, cast(16 + id % 7 as int)))"),
        (1, f"concat('api_key: ', {mixed})"),
        (1, f"concat('ghp_', substr(translate({mixed}, '+/', 'aZ'), 1, 30), '7Qx2')"),
        (1, f"concat('secret \"', {mixed}, '\"')"),
        (1, f"concat('Authorization: Bearer ', {mixed})"),
        (0, f"concat('commit ', substr({key}, 1, 40))"),
        (0, f"concat('sha256:', {key})"),
        (0, f"concat('md5 ', substr({key}, 1, 32))"),
        (0, f"concat('uuid ', regexp_replace(substr({key}, 1, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '$1-$2-$3-$4-'))"),
        (0, "concat('/usr/lib/python3/dist-packages/module_handler_', id, '/index.html')"),
        (0, "concat('4', lpad(cast(id * 104729 as string), 15, '3'))"),
        (0, "concat('getUserProfileVersion', id % 10, 'Handler')"),
        (0, "concat('token = \"xxxxxxxxxxxxxxxx', id % 10, '\"')"),
        (0, "concat('sample-config-test-', 20240000 + id)"),
        (0, "concat('backup-20', 10 + id % 15, '0102-', lpad(id % 1000000, 6, '0'))"),
        (0, "concat('password=examplepassword', id % 100)"),
        (0, "concat('www.example.com/article-about-', element_at(split('data-model page-name user-list', ' '), cast(1 + id % 3 as int)), '-', id)"),
        (0, f"concat('etag \"', substr({key}, 1, 20), '\"')"),
        (1, f"concat('AKIA', translate({caps}, '2345679', 'HIJKLMN'))"),
        (1, f"concat('password=', translate(substr({key}, 1, 6), '0123456789', 'ghijkmnpqr'), 10 + id % 90)"),
        (1, f"concat('secret: \"', translate({mixed}, '0123456789+/', 'abcdefghijkl'), '\"')"),
        (1, f"concat('password=', {phrase})"),
        (1, "concat('-----BEGIN ', element_at(split('RSA ,EC ,DSA ,OPENSSH ,', ','), cast(1 + id div 26 % 5 as int)), 'PRIVATE KEY-----')"),
        (0, f"concat(element_at(split('password: ,token = ,secret: ,auth: ,password=', ','), cast(1 + id div 26 % 5 as int)), {plain})"),
        (1, f"concat('postgres://admin:', {mixed.replace('48', '16')}, '@db.local/x')"),
        (1, f"concat('ftp://bob:', translate(substr({key}, 1, 8), '01', 'xy'), '!', id % 90, '@files.net')"),
        (1, f"concat('password: ', translate(substr({key}, 1, 7), '0123', 'pqst'), '&', id % 10, 'k', element_at(split('!@#$%^*', ''), cast(1 + id % 7 as int)), 'z')"),
        (1, f"concat('pwd=', {pick(nouns, 2)}, '@', id % 100, '#', substr({key}, 3, 3))"),
        (0, f"concat(element_at(split('token: ,auth = ,secret=,private: ', ','), cast(1 + id div 26 % 4 as int)), {camel})"),
        (0, f"concat(element_at(split('token: ,auth = ,secret=', ','), cast(1 + id div 26 % 3 as int)), lower({pick(parts_of_names, 4)}), '.', {camel})"),
        (0, f"concat('https://', {plain}, '.example.org:8080@', {plain})"),
    ]
    text = "CASE " + " ".join(f"WHEN id % {len(kinds)} = {k} THEN {e}" for k, (_, e) in enumerate(kinds)) + " END"
    label = f"CASE WHEN id % {len(kinds)} IN ({', '.join(str(k) for k, (y, _) in enumerate(kinds) if y)}) THEN 1 ELSE 0 END"
    return spark.range(first, first + rows).select(F.expr(f"concat({word}, ' ', {text}, ' ', {word})").alias("text"), F.expr(label).alias("label"), F.expr(f"id % {len(kinds)}").alias("kind"))


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, tried: int):
    """A tree as (feature, threshold, left, right) or the share of keys in its leaf."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 8:
        return share
    best, split = 1e-9, None
    for f in rng.choice(x.shape[1], tried, replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        left = cut + 1.0
        right, ls = len(y) - left, s[cut]
        rs = s[-1] - ls
        gain = ls * ls / left + rs * rs / right + (left - ls) ** 2 / left + (right - rs) ** 2 / right - (share**2 + (1 - share) ** 2) * len(y)
        k = int(gain.argmax())
        if gain[k] > best:
            best, split = gain[k], (int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
    if split is None:
        return share
    low = x[:, split[0]] <= split[1]
    return (*split, grow(x[low], y[low], rng, depth - 1, tried), grow(x[~low], y[~low], rng, depth - 1, tried))


def as_sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree:.6f}D"
    f, t, low, high = tree
    return f"CASE WHEN x.{FEATURES[f]} <= {t!r}D THEN {as_sql(low)} ELSE {as_sql(high)} END"


def train(findings: DataFrame, trees: int = 21, depth: int = 6, bound: int = 10_000, seed: int = 11) -> list:
    """A forest from at most ``bound`` labelled findings; each trains on the first candidate of its line."""
    rows = candidates(findings).where("size(_found) > 0").select(F.col("_features")[0].alias("x"), "label").orderBy(F.xxhash64("x", "label")).limit(bound).collect()
    x, y = np.array([[r.x[f] for f in FEATURES] for r in rows], float), np.array([r.label for r in rows], float)
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        k = rng.integers(len(y), size=len(y))
        out.append(grow(x[k], y[k], rng, depth, tried=4))
    return out


BLOCK = 128  # candidates whose lengths are summed one by one


def starts_of(values: Column, between: Column) -> Column:
    """Where each candidate begins, in characters: sums over whole blocks before its block, and over its block."""
    lengths = F.transform(values, lambda v, k: F.length(between[k]) + F.length(v))

    def of(sizes: Column) -> Column:
        add = lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: add(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
        before = let(blocks, lambda s: F.aggregate(s, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b))))
        inside = lambda k: add(F.slice(sizes, F.floor(k / BLOCK).cast("int") * BLOCK + 1, k % BLOCK + 1))
        return let(before, lambda p: F.transform(values, lambda v, k: p[F.floor(k / BLOCK).cast("int")] + inside(k) - F.length(v)))

    return let(lengths, of)


def scan(docs: DataFrame, forest: list, threshold: float = 0.5, mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with secrets in ``text`` masked; adds n_candidates, n_secrets and secrets (value, score, start)."""
    found = candidates(packed(docs), "doc.text")
    score = "(" + " + ".join(as_sql(t) for t in forest) + f") / {len(forest)}D"
    found = found.withColumn("_scores", F.expr(f"transform(_features, x -> {score})"))

    def out(x):
        """All columns that are added, from one struct of the candidates, the texts between them, and their scores."""
        values, between, scores = x["values"], x["between"], x["scores"]
        pieces = F.transform(values, lambda v, k: F.concat(F.when(scores[k] >= threshold, F.lit(mask)).otherwise(v), between[k + 1]))
        kept = F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda k: scores[k] >= threshold)
        return F.struct(F.concat(between[0], F.array_join(pieces, "")).alias("text"), let(starts_of(values, between), lambda at: F.transform(kept, lambda k: F.struct(values[k].alias("value"), scores[k].alias("score"), at[k].alias("start")))).alias("secrets"))

    nothing = F.struct(F.col("doc.text").alias("text"), F.array().cast("array<struct<value:string,score:double,start:int>>").alias("secrets"))
    some = F.exists("_scores", lambda s: s >= threshold)
    found = found.withColumn("_out", F.when(some, let(F.struct(F.col("_found").alias("values"), F.col("_between").alias("between"), F.col("_scores").alias("scores")), out)).otherwise(nothing))
    masked, kept = F.col("_out.text"), F.col("_out.secrets")
    return found.select(*unpacked(docs.columns, text=masked, n_candidates=F.size("_found").cast("long"), secrets=kept, n_secrets=F.size(kept).cast("long")))
