"""URL filters, with DataFrame functions only: rules first, then the ratio of two character language models.

Rules decide what they match. The URLs they decide teach two smoothed variable-order Markov models, of accepted and of rejected URLs;
every other URL goes by the difference of its log-likelihoods for each character, against a threshold calibrated on decided URLs that
the models did not see. The models hold every character as it is, in contexts of up to ORDER - 1 characters, and grow with the URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import LOWER, UPPER, ascii_lower, hash_52, hot_keys, join_skewed, stored, table

# The rules, longest first.
RULES = (("allow", "www.example.com/en/"), ("block", "example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"), ("allow", "com/"))
#: Characters of a gram; signs for what is before the first character and after the last.
ORDER, START, END = 5, "\x02", "\x03"
#: Of the decided URLs, one in FOLDS calibrates; log ratios are kept as whole millionths, so sums do not depend on their order.
FOLDS, UNIT = 5, 1e6
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. A rule fits its host and all subdomains, and paths that start with its own."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        named = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, named) if out is None else out.when(fits, named)
    return out


def grams(text: Column) -> Column:
    """Each character, and the end, after the ORDER - 1 before it. Takes time in proportion to the text."""
    signs = F.concat(F.array(*[F.lit(START)] * (ORDER - 1)), F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "")), F.array(F.lit(END)))
    run = lambda x, i: F.concat(*[F.get(x, i + k) for k in range(ORDER)])
    at = F.sequence(F.lit(0), F.char_length(text))
    return F.get(F.transform(F.array(signs), lambda x: F.transform(at, lambda i: run(x, i))), 0)  # x: so that the text is split once


def gram_counts(each: DataFrame) -> DataFrame:
    """(gram, n, a, b): how often each gram is in each(gram, a, b), and in accepted and rejected texts."""
    return each.groupBy("gram").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def gram_ratios(counts: DataFrame) -> DataFrame:
    """(gram, lr): for every gram of counts(gram, a, b) its log-ratio in millionths by the two models.

    Each order is interpolated with the one below by the Witten-Bell weight, the lowest with equal chances of all characters, so where
    a long context was not seen, or rarely, shorter ones decide. lr is 0 if either class has no text. The models grow with the texts:
    orders are joined one by one, and a gram meets at most as many others as there are characters, so no key is hot.
    """
    levels = {ORDER: counts.select("gram", "a", "b")}
    for k in range(ORDER - 1, 0, -1):
        shorter = levels[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        levels[k] = stored(shorter, f"grams-{k}")
    whole = levels[1].agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    same = F.lit(1.0) / F.greatest(F.lit(1), whole.select("n").scalar())
    below = None
    for k in range(1, ORDER + 1):
        level = levels[k].withColumn("context", F.substring("gram", 1, k - 1))
        seen = [F.sum(m).alias(f"n{m}") for m in "ab"] + [F.count_if(F.col(m) > 0).alias(f"t{m}") for m in "ab"]
        contexts = level.groupBy("context").agg(*seen)
        if below is None:
            level = level.join(F.broadcast(contexts), "context").withColumns({"pa": same, "pb": same})  # one row: the empty context
        else:
            level = level.join(contexts, "context").withColumn("rest", F.substring("gram", 2, k - 1)).join(below.withColumnRenamed("gram", "rest"), "rest")
        mixed = {f"p{m}": F.when(F.col(f"n{m}") > 0, (F.col(m) + F.col(f"t{m}") * F.col(f"p{m}")) / (F.col(f"n{m}") + F.col(f"t{m}")).cast("double")).otherwise(F.col(f"p{m}")) for m in "ab"}
        below = level.withColumns(mixed).select("gram", "pa", "pb")  # used once, by the next order
    known = (whole.select("a").scalar() > 0) & (whole.select("b").scalar() > 0)
    return below.select("gram", F.when(known, F.round((F.log("pa") - F.log("pb")) * UNIT)).otherwise(0.0).cast("long").alias("lr"))


def score_texts(texts: DataFrame) -> DataFrame:
    """(id, score) of texts(id, text, allow, block, held): the mean log-ratio of a text's characters, in millionths.

    The models learn from accepted and rejected texts that are not held out. Grams that many texts hold are met by broadcast.
    """
    learn = lambda c: (F.col(c) & ~F.col("held")).cast("long")
    each = texts.select("id", F.explode(grams(F.col("text"))).alias("gram"), learn("allow").alias("a"), learn("block").alias("b"))
    counts = stored(gram_counts(each), "grams")
    ratios = stored(gram_ratios(counts), "ratios")
    return join_skewed(each.select("id", "gram"), ratios, ["gram"], hot_keys(counts, ["gram"])).groupBy("id").agg((F.sum("lr") / F.count("*")).alias("score"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict, score) for every row.

    A null URL counts as empty; it, and one without ://, has an empty host and path; no rule fits it and the models judge its text.
    Models read whole URLs, of any length, query and fragment too. Where the rules leave either class without a URL, every score is 0
    and the verdict allow. Equal URLs get equal verdicts and count once in the models; a hot URL's rows meet its verdict by broadcast.
    Rows with equal or null ids keep their own verdicts; an empty table gives an empty result. Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("row"), F.coalesce(url_col, F.lit("")).alias("text"))
    texts = rows.groupBy("text").agg(F.count("*").alias("n")).withColumns({"host": host_of(F.col("text")), "path": path_of(F.col("text"))})
    texts = texts.withColumn("m", match_rule(F.col("host"), F.col("path"), rules))
    is_ = lambda v: F.coalesce(F.col("m.verdict") == v, F.lit(False))
    texts = texts.withColumns({"allow": is_("allow"), "block": is_("block"), "held": hash_52(F.col("text")) % FOLDS == 0, "id": F.monotonically_increasing_id()})
    texts = stored(texts, "urls")
    scored = stored(texts.join(score_texts(texts), "id"), "scores")
    side = lambda v: (F.avg(F.when(F.col(v), F.col("score"))), F.coalesce(F.stddev_pop(F.when(F.col(v), F.col("score"))), F.lit(0.0)) + 1.0)
    (a, sa), (b, sb) = side("allow"), side("block")
    threshold = scored.where("held").agg(F.coalesce((a * sb + b * sa) / (sa + sb), F.lit(0.0)).alias("t")).scalar()
    verdict = F.coalesce("m.verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    judged = scored.select("text", "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"), "score")
    return join_skewed(rows, judged, ["text"], hot_keys(texts, ["text"])).select(F.col("row").alias(id_col), "host", "path", "rule", "verdict", "score")


def op3_url_filters(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages")).drop("score")


def _sql() -> str:
    cases = {"rule": "", "verdict": ""}
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        at, _, rest = rule.partition("/")
        for k, v in (("rule", rule), ("verdict", verdict)):
            cases[k] += f" WHEN (host = '{at}' OR suffix(host, '.{at}')) AND starts_with(path, '/{rest}') THEN '{v}'"
    parts = [f"""urls AS (SELECT DISTINCT coalesce(url, '') AS url FROM pages),
hosts AS (SELECT url, translate(regexp_extract(url, '{PARTS}', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(url, '{PARTS}', 2) AS path FROM urls),
texts AS (SELECT *, CASE{cases["rule"]} END AS rule, CASE{cases["verdict"]} END AS given, ('0x' || substr(md5(url), 1, 13))::BIGINT % {FOLDS} = 0 AS held FROM hosts),
signs AS (SELECT *, repeat(chr(2), {ORDER - 1}) || url || chr(3) AS padded, unnest(range(1, length(url) + 2)) AS i FROM texts),
marks AS (SELECT url, substring(padded, i, {ORDER}) AS gram, (given = 'allow' AND NOT held) IS TRUE AS a, (given = 'block' AND NOT held) IS TRUE AS b FROM signs),
level{ORDER} AS (SELECT gram, sum(a::INT)::BIGINT AS a, sum(b::INT)::BIGINT AS b FROM marks GROUP BY 1)"""]
    parts += [f"level{k} AS (SELECT substring(gram, 2, {k}) AS gram, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b FROM level{k + 1} GROUP BY 1)" for k in range(ORDER - 1, 0, -1)]
    parts.append("chance0 AS (SELECT '' AS gram, 1.0::DOUBLE / count(*) AS pa, 1.0::DOUBLE / count(*) AS pb FROM level1)")
    for k in range(1, ORDER + 1):
        parts.append(f"context{k} AS (SELECT substring(gram, 1, {k - 1}) AS context, sum(a)::BIGINT AS na, sum(b)::BIGINT AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM level{k} GROUP BY 1)")
        mix = ", ".join(f"CASE WHEN n{m} > 0 THEN (l.{m}::DOUBLE + t{m}::DOUBLE * p.p{m}) / (n{m} + t{m})::DOUBLE ELSE p.p{m} END AS p{m}" for m in "ab")
        parts.append(f"chance{k} AS (SELECT l.gram, {mix} FROM level{k} l JOIN context{k} c ON c.context = substring(l.gram, 1, {k - 1}) JOIN chance{k - 1} p ON p.gram = substring(l.gram, 2, {k - 1}))")
    return f"""WITH {", ".join(parts)},
ratios AS (SELECT gram, CASE WHEN (SELECT sum(a) > 0 AND sum(b) > 0 FROM level1) THEN round((ln(pa) - ln(pb)) * {UNIT})::BIGINT ELSE 0 END AS lr FROM chance{ORDER}),
scores AS (SELECT url, sum(lr)::DOUBLE / count(*) AS score FROM marks JOIN ratios USING (gram) GROUP BY 1),
known AS (SELECT avg(score) FILTER (given = 'allow') AS a, avg(score) FILTER (given = 'block') AS b,
  coalesce(stddev_pop(score) FILTER (given = 'allow'), 0) + 1 AS sa, coalesce(stddev_pop(score) FILTER (given = 'block'), 0) + 1 AS sb FROM texts JOIN scores USING (url) WHERE held)
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN score >= (SELECT coalesce((a * sb + b * sa) / (sa + sb), 0) FROM known) THEN 'allow' ELSE 'block' END) AS verdict
FROM pages p JOIN texts t ON t.url = coalesce(p.url, '') JOIN scores s ON s.url = t.url"""


QUERIES = {"op3_url_filters": op3_url_filters}
ORACLE = {"op3_url_filters": _sql()}
