"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule decides are the examples: those allowed train one model, those blocked the
other.  A model is a smoothed Markov model of variable order over the characters of a URL
behind its ``://`` (host in lower case) up to an end mark: the probability of a character
after a context is that of the context, blended with the one of the context without its
first character in the proportion of Witten and Bell (as many parts for the shorter context
as different characters have followed), down to all characters alike.  A context without
examples leaves the shorter one's value, so the order adapts to what was seen.

The score of a URL is the logarithm of the two probabilities' ratio divided by its number of
characters.  A quarter of the decided URLs, by hash, trains nothing; on them the score is
calibrated: of the edges of a fixed scale that one is taken which wrongly keeps and wrongly
drops the smallest shares of the blocked and the allowed, the one nearest to zero of equals.
URLs below it are blocked.

Every row counts, repeated ones as often as they occur.  Counts are taken once for the
longest context and summed for shorter ones, so tables grow with the number of different
stretches in the corpus.  Stretches that make up more than one part in ``HEAVY`` of all are
``HEAVY`` at most and are joined by broadcast; no other one is frequent enough to burden a task.

Only DataFrame functions are used.  Null and empty URLs have nothing to judge: their score
is null and they are allowed unless a rule blocks them.  Without ``://`` host and path are empty and
all of the URL is judged.  Without allowed or without blocked examples nothing is known of
the difference and all is allowed; without decided URLs to calibrate on the edge is zero.
Characters never seen get the probability of any other.  Very long URLs are scored whole, in
time proportional to their length.  Null ``page_id`` stays null, an empty table gives no rows,
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import LOWER, UPPER
from corpusflow.scratch import stored

#: Rules ``(action, host, path)`` of the contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

ORDER = 4
HEAVY = 4096
#: Steps of one nat: of a score, and of the scale on which it is calibrated.
GRID = 1 << 20
EDGES = 1 << 8

#: Marks before the first and behind the last character.
START, END = "\x02", "\x03"


def url_parts(url: Column) -> dict[str, Column]:
    """``host``, ``path`` and ``body``: what the models read."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    body = F.concat(host, F.regexp_replace(rest, "^[^/?#]*", ""))
    empty = F.lit("")
    return {"host": F.coalesce(host, empty), "path": F.coalesce(path, empty), "body": F.coalesce(body, url, empty)}


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits, ties by text; null where none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, at, start in reversed(ordered):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(start))
        text, action = F.when(fits, at + start).otherwise(text), F.when(fits, verdict).otherwise(action)
    return text, action


def _stretches(body: Column, order: int) -> Column:
    """Every character with the ``order`` before it, the end mark last."""
    letters = F.concat(F.array_repeat(F.lit(START), order), F.regexp_extract_all(body, F.lit("(?s)."), F.lit(0)), F.array(F.lit(END)))
    place = lambda i: F.array_join(F.slice(letters, i, F.lit(order + 1)), "")
    return F.transform(F.sequence(F.lit(1), F.size(letters) - order), place)


def _logs(stretches: DataFrame, order: int) -> DataFrame:
    """``gram, llr``: difference of the models' logarithms for every stretch of ``stretches(gram, a, r)``.

    Level by level: shorter contexts first.  Joins meet as many rows a key as there are
    different characters.
    """
    total = lambda c: F.sum(c).alias(c)
    counts = {order + 1: stretches}
    for size in range(order, 0, -1):
        counts[size] = stored(counts[size + 1].select(F.expr(f"right(gram, {size})").alias("gram"), "a", "r").groupBy("gram").agg(total("a"), total("r")), "counts")
    kinds = counts[1].count()
    below = None
    for size in range(1, order + 2):
        rows = counts[size].select("gram", "a", "r", F.expr(f"left(gram, {size - 1})").alias("context"), F.expr(f"right(gram, {size - 1})").alias("lower"))
        seen = rows.groupBy("context").agg(*[f(x) for x in "ar" for f in (
            lambda x: F.sum(x).alias(f"n{x}"), lambda x: F.count_if(F.col(x) > 0).alias(f"t{x}"),
        )])
        rows = rows.join(seen, "context")
        if below is None:
            rows = rows.withColumns({"pa": F.lit(1 / kinds), "pr": F.lit(1 / kinds)})
        else:
            rows = rows.join(below.withColumnRenamed("gram", "lower"), "lower")
        blend = lambda x: F.when(F.col(f"n{x}") > 0, (F.col(x) + F.col(f"t{x}") * F.col(f"p{x}")) / (F.col(f"n{x}") + F.col(f"t{x}"))).otherwise(F.col(f"p{x}"))
        below = stored(rows.select("gram", blend("a").alias("pa"), blend("r").alias("pr")), "chances")
    return below.select("gram", F.round((F.log("pa") - F.log("pr")) * GRID).cast("long").alias("llr"))


def _edge(scored: DataFrame) -> int:
    """The edge, in steps of ``EDGES`` a nat, that parts the decided URLs held back with least harm.

    The scale is fixed, so the histogram has some thousand rows however many URLs there are.
    """
    at = F.floor(F.col("steps") / (GRID // EDGES)).alias("bin")
    known = scored.where("held AND action IS NOT NULL AND steps IS NOT NULL")
    bins = known.groupBy(at).agg(F.count_if(F.col("action") == "allow").alias("a"), F.count_if(F.col("action") == "block").alias("r")).collect()
    allowed, blocked = sum(b["a"] for b in bins), sum(b["r"] for b in bins)
    if not allowed or not blocked:
        return 0
    counts = {b["bin"]: (b["a"], b["r"]) for b in bins}
    dropped, kept, choices = 0, blocked, []
    for edge in sorted({*counts, *(b + 1 for b in counts), 0}):
        before = counts.get(edge - 1, (0, 0))
        if choices:
            dropped, kept = dropped + before[0], kept - before[1]
        # shares over a common denominator, so that ties are exact
        choices.append((dropped * blocked + kept * allowed, abs(edge), edge))
    return min(choices)[2]


def judge_urls(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages(page_id, url)``."""
    parts = url_parts(F.col("url"))
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", *[c.alias(name) for name, c in parts.items()])
    text, action = rule_of(F.col("host"), F.col("path"), rules)
    held = F.substring(F.md5(F.col("body").cast("binary")), 1, 1) < "4"
    rows = stored(rows.select("*", text.alias("rule"), action.alias("action"), held.alias("held")), "urls")
    each = rows.where("body <> ''").select("rid", "action", "held", F.explode(_stretches(F.col("body"), order)).alias("gram"))
    trains = lambda verdict: F.count_if((F.col("action") == verdict) & ~F.col("held"))
    grams = stored(each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), trains("allow").alias("a"), trains("block").alias("r")), "grams")
    total, accepted, rejected = grams.agg(F.sum("n"), F.sum("a"), F.sum("r")).first()
    if not accepted or not rejected:
        verdict = F.coalesce("action", F.lit("allow")).alias("verdict")
        return rows.select("page_id", "host", "path", "rule", verdict, F.lit(None).cast("double").alias("score"))
    logs = stored(_logs(grams.select("gram", "a", "r"), order).join(grams.select("gram", "n"), "gram"), "logs")
    heavy = F.col("n") * HEAVY > total
    # at most HEAVY rows, whatever the corpus
    met = each.select("rid", "gram").join(F.broadcast(logs.where(heavy).select("gram", "llr")), "gram", "left")
    rare = met.where("llr IS NULL").select("rid", "gram").join(logs.where(~heavy).select("gram", "llr").hint("shuffle_hash"), "gram")
    sums = met.where("llr IS NOT NULL").select("rid", "llr").unionByName(rare.select("rid", "llr")).groupBy("rid")
    sums = sums.agg(F.sum("llr").alias("sum"), F.count(F.lit(1)).alias("size"))
    steps = F.floor(F.col("sum") / F.col("size")).cast("long")
    scored = stored(rows.join(sums, "rid", "left").select("page_id", "host", "path", "rule", "action", "held", steps.alias("steps"), (steps / GRID).alias("score")), "scored")
    edge = _edge(scored)
    judged = F.when(F.col("steps") < edge * (GRID // EDGES), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("action", judged).alias("verdict"), "score")
