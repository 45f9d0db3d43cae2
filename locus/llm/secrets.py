"""Secret scans: candidates by pattern, false positives removed by a random forest.

Everything is DataFrame functions: candidates are found in the words of a text, features are expressions
over the candidate, its word and the words beside it, the forest is grown level by level from counts by
tree, node, feature and bin, and a grown tree is a nested CASE. The labelled findings to learn from are a
parameter; without one they are made by rule (labelled_findings), as no table of findings exists.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.common import table, whole, written

WORDS = r"[\x20\x09-\x0D]+"
#: Runs of key characters that hold a digit, or what is assigned to a name that says it is secret.
CANDIDATE = r"""(?i)(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}|(?<=(?:password|passwd|secret|token|api_key|apikey)["']?[=:]["']?)[^\s"',;=]{8,}"""
#: What is assigned, with spaces, to such a name in one of the two words before.
NAME = r"""(?i)(?:password|passwd|secret|token|api_key|apikey)["']?"""
VALUE = r"""[^\s"',;=]{8,}"""
LEAST = 8

KEY_WORDS = r"(?i)(pass(word|wd|phrase)?|secret|token|api[_\-]?key|access[_\-]?key|auth|credential|bearer|private)"
PLAIN_WORDS = r"(?i)(commit|sha\d*|md5|digest|checksum|hash|uuid|guid|revision|isbn|order|invoice|phone|example|sample|dummy|href|src|version)"
TEST_PATHS = r"(?i)(test|example|sample|fixture|mock|docs?/)"
#: Words that make candidates plain text.
DICTIONARY = (
    "able access account action analysis and any app array asset async backup base batch between block branch build cache call case check class "
    "client code column config connection content context control core count create data date debug default delete design device document edit "
    "engine error event example export feature field file font form from function general get global group header help host html image import "
    "index info input install item job key lang last lib library license link list local log main map member menu message meta method model "
    "module node object old open option order output package page part path phase photo plan point policy post print process product profile "
    "project python query queue read record release report request resource result review role root route row rule run sample save scan schema "
    "screen script search section select server service session set shared site size source spec stage start state status step store story stream "
    "string style summary system table tag target task team temp template test text that the theme thread time title total track type unit update "
    "upload user util value version view web week with word work write year zone"
).split()

FEATURES = ("length", "transitions", "digits", "upper", "distinct", "hex", "dictionary", "slashes", "dashes", "runs", "assigned", "key_near", "plain_near", "test_path")


def _before(words: Column, i: Column, k: int) -> Column:
    return F.coalesce(F.get(words, i - k), F.lit(""))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """doc_id, word (its number, from 0), nth (in the word), candidate, host (the word), near (the two words
    before and the one after) and path. No text is cut, and every word of it is looked at."""
    words = F.split(whole(text_col), WORDS)
    one_before, two_before = (lambda i, k=k: _before(F.col("__w"), i, k) for k in (1, 2))
    spaced = lambda i: one_before(i).rlike(NAME + "[=:]$") | (one_before(i).rlike("^[=:]$") & two_before(i).rlike(NAME + "$")) | (F.get("__w", i).rlike("^[=:]") & one_before(i).rlike(NAME + "$"))
    holds = lambda i: F.get("__w", i).rlike(CANDIDATE) | (F.get("__w", i).rlike(VALUE) & spaced(i))
    numbers = F.filter(F.sequence(F.lit(0), F.size("__w") - 1), lambda i: (F.length(F.get("__w", i)) >= LEAST) & holds(i))
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("__w"), (F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")).alias("path"))
    hits = F.transform(numbers, lambda i: F.struct(i.cast("long").alias("word"), F.get("__w", i).alias("host"), F.concat_ws(" ", _before(F.col("__w"), i, 2), _before(F.col("__w"), i, 1), _before(F.col("__w"), i, -1)).alias("near"), spaced(i).alias("spaced")))
    one = found.select("doc_id", "path", F.explode(hits).alias("h")).select("doc_id", "path", "h.*")
    of = F.when(F.col("spaced"), F.regexp_extract_all("host", F.lit(VALUE), F.lit(0))).otherwise(F.regexp_extract_all("host", F.lit(CANDIDATE), F.lit(0)))
    return one.select("doc_id", "word", F.posexplode(of).alias("nth", "candidate"), "host", "near", "path")


def features(found: DataFrame) -> DataFrame:
    """found with one double column for each of FEATURES; a null candidate, host, near or path is empty."""
    c, host, near, path = (F.coalesce(F.col(x), F.lit("")) for x in ("candidate", "host", "near", "path"))
    n = F.greatest(F.length(c), F.lit(1)).cast("double")
    changes = F.regexp_count(c, F.lit(r"[a-z](?![a-z])|[A-Z](?![A-Za-z])|[0-9](?![0-9])|[+/_\-](?=[A-Za-z0-9])"))
    plain = F.regexp_replace(F.lower(c), "(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")", "")
    by = {
        "length": F.length(c), "transitions": changes / n, "digits": F.regexp_count(c, F.lit("[0-9]")) / n, "upper": F.regexp_count(c, F.lit("[A-Z]")) / n,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n, "hex": c.rlike("^[0-9a-f]+$"), "dictionary": 1 - F.length(plain) / n,
        "slashes": F.regexp_count(host, F.lit(r"[/\\]")), "dashes": F.regexp_count(c, F.lit(r"[\-_]")), "runs": F.regexp_count(c, F.lit(r"(.)\1\1")),
        "assigned": F.concat(host, F.lit(" "), near).rlike("[=:]"), "key_near": F.concat(near, F.lit(" "), host).rlike(KEY_WORDS), "plain_near": F.concat(near, F.lit(" "), host).rlike(PLAIN_WORDS), "test_path": path.rlike(TEST_PATHS),
    }
    return found.withColumns({f"f_{k}": (v.cast("int") if k in ("hex", "assigned", "key_near", "plain_near", "test_path") else v).cast("double") for k, v in by.items()})


def labelled_findings(spark: SparkSession, rows: int = 1400, seed: int = 9) -> DataFrame:
    """candidate, host, near, path and label (1: a secret), made by rule from numbers: access keys, assigned
    passwords and tokens of several alphabets against digests, identifiers, paths, numbers and placeholders.
    Kinds overlap: what is assigned in a test or an example is no secret though it looks the same."""
    h = "sha2(concat('{}', id, '-{}'), 512)"
    hexes, other = h.format("a", seed), h.format("b", seed)
    upper = f"translate(upper({hexes}), '0123456789ABCDEF', 'QX7WZ2KJ5VB3MHGT')"
    mixed = f"translate({hexes}, '0123456789abcdef', 'xQ7wZ2kJ5vB3mHgT')"
    word = lambda k: f"element_at(split('{' '.join(DICTIONARY)}', ' '), cast(pmod(xxhash64(id, {k}), {len(DICTIONARY)}) + 1 as int))"
    name = "element_at(array('password', 'passwd', 'secret', 'token', 'api_key', 'auth_token', 'client_secret', 'access_key'), cast(pmod(xxhash64(id, 5), 8) + 1 as int))"
    digest = "element_at(array('commit', 'sha256', 'md5', 'digest', 'checksum', 'revision'), cast(pmod(xxhash64(id, 6), 6) + 1 as int))"
    plain = f"concat({word(11)}, ' ', {word(12)})"
    kinds = [  # label, candidate, host with {c} for the candidate, the words near
        (1, f"concat('AKIA', substr({upper}, 1, 16))", "{c}", plain),
        (1, f"substr({hexes}, 1, cast(12 + pmod(xxhash64(id, 7), 20) as int))", f"concat({name}, '=', {{c}})", plain),
        (1, f"substr({hexes}, 1, 40)", "concat('\"', {c}, '\"')", f"concat({name}, ' =')"),
        (1, f"substr({mixed}, 1, cast(20 + pmod(xxhash64(id, 8), 30) as int))", f"concat({name}, ':', {{c}})", plain),
        (1, f"substr({mixed}, 1, cast(20 + pmod(xxhash64(id, 8), 24) as int))", "{c}", f"concat({name}, ':')"),
        (1, f"substr({mixed}, 1, cast(8 + pmod(xxhash64(id, 8), 12) as int))", "concat('\"', {c}, '\"')", f"concat({name}, ' =')"),
        (1, f"substr(translate({hexes}, '0123456789', 'qrstuvwxyz'), 1, cast(10 + pmod(xxhash64(id, 8), 16) as int))", "{c}", f"concat({word(20)}, ' ', {name}, ':')"),
        (1, f"concat({word(21)}, pmod(xxhash64(id, 22), 90), {word(23)})", "{c}", f"concat({word(20)}, ' ', {name}, ':')"),
        (1, f"concat('ghx_', substr({mixed}, 1, 36))", "{c}", plain),
        (0, f"substr({hexes}, 1, 40)", "{c}", f"concat({word(13)}, ' ', {digest})"),
        (0, f"substr({other}, 1, 64)", f"concat({digest}, ':', {{c}})", plain),
        (0, f"concat(substr({hexes}, 1, 8), '-', substr({hexes}, 9, 4), '-4', substr({hexes}, 13, 3), '-a', substr({hexes}, 16, 3), '-', substr({hexes}, 20, 12))", "{c}", f"concat({word(14)}, ' id')"),
        (0, f"concat_ws('-', {word(15)}, {word(16)}, pmod(xxhash64(id, 9), 90), {word(17)})", "{c}", plain),
        (0, f"concat_ws('/', {word(15)}, {word(16)}, concat({word(17)}, pmod(xxhash64(id, 9), 9)), {word(18)})", "concat('/', {c})", plain),
        (0, f"concat({word(15)}, initcap({word(16)}), pmod(xxhash64(id, 9), 9), initcap({word(17)}), initcap({word(18)}))", "{c}", plain),
        (0, "substr(translate(" + hexes + ", 'abcdef', '142857'), 1, cast(16 + pmod(xxhash64(id, 9), 5) as int))", "{c}", f"concat('order ', {word(14)})"),
        (0, "concat('xxxxxxxxxxxxxxxx', pmod(xxhash64(id, 9), 90))", f"concat({name}, '=', {{c}})", "'example'"),
        (0, f"substr({hexes}, 1, 40)", "concat('\"', {c}, '\"')", f"concat({name}, ' =')"),
        (0, f"substr({mixed}, 1, cast(8 + pmod(xxhash64(id, 8), 12) as int))", "concat('\"', {c}, '\"')", f"concat({name}, ' =')"),
    ]
    in_tests = f"concat(element_at(array('tests/', 'src/test/', 'examples/', 'docs/'), cast(pmod(xxhash64(id, 32), 4) + 1 as int)), {word(33)}, '.py')"
    elsewhere = f"CASE WHEN pmod(xxhash64(id, 34), 2) = 0 THEN '' ELSE concat({word(35)}, '/', {word(36)}, '.py') END"
    paths = [in_tests if k >= len(kinds) - 2 else f"CASE WHEN pmod(xxhash64(id, 37), {3 if label == 0 else 12}) = 0 THEN {in_tests} ELSE {elsewhere} END" for k, (label, *_) in enumerate(kinds)]
    kind = spark.range(rows).selectExpr("id", f"cast(pmod(id, {len(kinds)}) as int) AS kind")
    case = lambda xs: "CASE kind " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(xs)) + " END"
    made = kind.selectExpr("id", "kind", case([c for _, c, _, _ in kinds]) + " AS candidate", case([str(y) for y, _, _, _ in kinds]) + " AS label")
    return made.selectExpr("candidate", case([x.replace("{c}", "candidate") for _, _, x, _ in kinds]) + " AS host", "concat(" + case([x for _, _, _, x in kinds]) + f", ' ', {word(19)}) AS near", case(paths) + " AS path", "label")


def _gain(left: tuple[float, float], right: tuple[float, float]) -> float:
    """By how much a split lowers the Gini impurity, weighted by rows."""
    gini = lambda n, y: 2 * y * (n - y) / n if n else 0.0
    return gini(left[0] + right[0], left[1] + right[1]) - gini(*left) - gini(*right)


def _tree_case(tree: dict, node: int) -> Column:
    if node not in tree["split"]:
        return F.lit(float(tree["leaf"][node]))
    feature, cut = tree["split"][node]
    return F.when(F.col(f"f_{feature}") <= cut, _tree_case(tree, 2 * node)).otherwise(_tree_case(tree, 2 * node + 1))


def grow(findings: DataFrame, trees: int = 10, depth: int = 5, bins: int = 10, share: float = 0.5, seed: int = 9) -> list[dict]:
    """A random forest: each tree sees a bootstrap of the findings (weights from a hash) and at each node
    a share of the features. What comes to the driver are counts by tree, node, feature and bin."""
    x = features(findings.filter("candidate IS NOT NULL AND label IS NOT NULL")).select("label", "candidate", "near", *[f"f_{k}" for k in FEATURES])
    x = written(x, "findings")
    quantiles = [k / bins for k in range(1, bins)]
    cuts = dict(zip(FEATURES, x.agg(*[F.percentile_approx(f"f_{k}", quantiles).alias(k) for k in FEATURES]).first() or [None] * len(FEATURES), strict=True))
    cuts = {k: sorted(set(v or [])) for k, v in cuts.items()}
    draw = F.pmod(F.xxhash64("candidate", "near", "t", F.lit(seed)), F.lit(1000)) / 1000
    poisson = F.when(draw < 0.368, 0).when(draw < 0.736, 1).when(draw < 0.920, 2).when(draw < 0.981, 3).otherwise(4)
    rows = x.withColumn("t", F.explode(F.array(*map(F.lit, range(trees))))).withColumn("w", poisson).filter("w > 0")
    bin_of = lambda k: sum((F.col(f"f_{k}") > c).cast("int") for c in cuts[k]) if cuts[k] else F.lit(0)
    binned = rows.select("t", "w", "label", F.lit(1).alias("node"), *[bin_of(k).cast("int").alias(f"b_{k}") for k in FEATURES])
    forest = [{"split": {}, "leaf": {}} for _ in range(trees)]
    for level in range(depth + 1):
        long = binned.select("t", "node", "w", "label", F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col(f"b_{k}").alias("b")) for k in FEATURES])).alias("x"))
        counts = long.groupBy("t", "node", "x.f", "x.b").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label")).alias("y")).collect()
        by: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(lambda: (0.0, 0.0))))
        for r in counts:
            by[r["t"], r["node"]][r["f"]][r["b"]] = (float(r["n"]), float(r["y"]))
        grown = []
        for (t, node), stats in sorted(by.items()):
            n, y = (sum(v[i] for v in next(iter(stats.values())).values()) for i in (0, 1))
            forest[t]["leaf"][node] = (y + 0.5) / (n + 1)
            best = (1e-9, None, 0)
            for k in FEATURES:
                if level == depth or not 0 < y < n or hash_share(t, node, k, seed) >= share:
                    continue
                left = (0.0, 0.0)
                for b in range(len(cuts[k])):
                    left = (left[0] + stats[k][b][0], left[1] + stats[k][b][1])
                    gain = _gain(left, (n - left[0], y - left[1]))
                    if gain > best[0]:
                        best = (gain, k, b)
            if best[1]:
                forest[t]["split"][node] = (best[1], cuts[best[1]][best[2]])
                grown.append((t, node, best[1], best[2]))
        if not grown:
            break
        side = F.lit(None).cast("int")
        for t, node, k, b in grown:
            side = F.when((F.col("t") == t) & (F.col("node") == node), F.col("node") * 2 + (F.col(f"b_{k}") > b).cast("int")).otherwise(side)
        binned = written(binned.withColumn("node", side).filter("node IS NOT NULL"), "level")
    return forest


def hash_share(*of) -> float:
    """A number from 0 to 1 that follows from its arguments."""
    return zlib.crc32(repr(of).encode()) / 2**32


def probability(forest: list[dict]) -> Column:
    return sum(_tree_case(t, 1) if t["leaf"] else F.lit(0.5) for t in forest) / max(1, len(forest))


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", **how) -> DataFrame:
    """A row for each candidate of each text: doc_id, word, nth, length, candidate_sha256, score, is_secret.

    Secrets are given by their digest, never in clear. A null or empty text has no candidates; repeated
    rows are scanned each; very long texts are split into words like others, and no word is cut; a null path
    is empty; other columns, whatever their names, aren't looked at; an empty table gives an empty result. Without labelled
    findings of both kinds every score is the share of the kind there is, or a half.
    """
    forest = grow(labelled_findings(docs.sparkSession) if findings is None else findings, **how)
    scored = features(candidates(docs, id_col, text_col, path_col)).withColumn("score", F.round(probability(forest), 6))
    return scored.select("doc_id", "word", F.col("nth").cast("long").alias("nth"), F.length("candidate").cast("long").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), "score", (F.col("score") >= threshold).alias("is_secret"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
