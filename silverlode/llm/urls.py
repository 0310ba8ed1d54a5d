"""URL filters: rules by host and path, then logistic regression on hashed character n-grams.

Everything, training included, is in DataFrame functions. Host and path each give n-grams, marked by
where they come from and hashed into a fixed number of weights. The training table is small by
contract (``MAX_ROWS``), so one row holds it and gradient descent is a fold over that row.

Cases, by definition: a null url, or one without ``://``, has empty host and path, fits no rule and is
judged on no n-grams, by the bias alone; repeated rows are judged alike; urls are read whole; an empty
table gives an empty result; extra columns are kept, whatever their names; ties of rules cannot be, as
longer wins and rules differ; a score equal to the threshold allows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import fresh

OUTPUTS = ("_host", "_path", "_rule", "_score", "_verdict")
DIMENSIONS = 2048
GRAMS = (3, 4)
STEPS, RATE, L2 = 200, 8.0, 1e-4
MAX_ROWS = 1000

#: Fixed values, longest match wins: (verdict, host, path).
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: The labelled table: hosts and paths in plain words, each bad or good by itself. A bad part is seen with
#: plain parts of the other kind, a good part with good and plain ones, so that host and path each carry weight.
BAD_HOSTS = (
    "spammy-offers spam-network linkspam farm-of-links cheapest-meds cheap-viagra pillstore rx-pills casino-royal casinobonus online-casino freemoney-now free-cash "
    "adult-chat sexcams xxx-videos hot-singles winprizes prize-winner lottery-claims payday-cash quick-loans clickbait-daily replica-watches betting-tips poker-slots miracle-diet crypto-doubler"
).split()
GOOD_HOSTS = (
    "library museum university news daily-paper garden school weather history recipes research archive city-council science music hospital railway observatory parliament theatre "
    "flower-shop county-fair school-district open-data city-guide music-lessons bird-watching town-hall book-club art-gallery public-radio "
    "blog wiki forum photos travel cooking sports chess birds mountains rivers engineering mathematics dictionary language children community software maps radio gallery"
).split()
BAD_PATHS = "/casino/bonus /free-money/now /cheap-pills/buy /win/prize-claim /xxx/cams/live /payday-loan/apply /viagra/order /hot-singles/chat /bet/slots/spin /replica/watches /click/spam/here /lottery/winner".split()
GOOD_PATHS = "/about /article/2019/spring /docs/guide.html /news/local/41 /fr/12 /en/7 /de/345/ /es/78.html /research/paper.pdf /people/team /events/may /images/map.png /archive/1998/06 /contact /search /index.html /pt/3 /it/9".split()
PLAIN_HOSTS = "site home page portal host server mirror static media main".split()
DOMAINS = ("example.com", "example.net", "example.org", "test.invalid")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, bad)``: the bad hosts under good paths, the bad paths under plain hosts, and good and plain hosts under good paths."""
    pairs = [(1, h, GOOD_PATHS[i % len(GOOD_PATHS)]) for i, h in enumerate(BAD_HOSTS * 4)]
    pairs += [(1, PLAIN_HOSTS[i % len(PLAIN_HOSTS)], p) for i, p in enumerate(BAD_PATHS * 7)]
    pairs += [(0, h, GOOD_PATHS[(i + i // 40) % len(GOOD_PATHS)]) for i, h in enumerate(GOOD_HOSTS * 8)]
    pairs += [(0, PLAIN_HOSTS[i % len(PLAIN_HOSTS)], GOOD_PATHS[(i * 7) % len(GOOD_PATHS)]) for i in range(120)]
    rows = [(f"https://{'www.' if i % 3 == 0 else ''}{h}.{DOMAINS[i * 5 // 3 % len(DOMAINS)]}{p}", bad) for i, (bad, h, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "url string, bad int")


def host(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(hosts: Column, paths: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as written, and its verdict; nulls if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1])):
        fits = ((hosts == name) | hosts.endswith("." + name)) & paths.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def buckets(hosts: Column, paths: Column, dimensions: int = DIMENSIONS, grams=GRAMS) -> Column:
    """The distinct hashed n-grams of both parts."""
    parts = []
    for mark, part in (("h", F.concat(F.lit("^"), hosts, F.lit("$"))), ("p", F.concat(F.lit("^"), paths, F.lit("$")))):
        for n in grams:
            count = F.length(part) - n + 1
            starts = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))
            parts.append(F.transform(starts, _hashed(mark, part, n, dimensions)))
    return F.array_distinct(F.concat(*parts))


def _hashed(mark: str, part: Column, n: int, dimensions: int):
    return lambda i: F.pmod(F.xxhash64(F.lit(mark), part.substr(i, F.lit(n))), F.lit(dimensions)).cast("int")


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def _score(found: Column, weights: Column, bias: Column) -> Column:
    """The bias and the mean-scaled sum of the weights of the buckets."""
    total = F.aggregate(found, F.lit(0.0), lambda a, b: a + F.element_at(weights, b + 1))
    return bias + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))


def train(labelled: DataFrame, url: str = "url", bad: str = "bad", dimensions: int = DIMENSIONS, steps: int = STEPS, rate: float = RATE, l2: float = L2) -> list[float]:
    """Weights and, last, the bias, by full-batch gradient descent as one fold over the gathered table."""
    known = labelled.where(F.col(url).isNotNull() & F.col(bad).isNotNull())
    if known.limit(MAX_ROWS + 1).count() > MAX_ROWS:
        raise ValueError(f"the labelled table is to have {MAX_ROWS} rows at most")
    rows = known.select(F.struct(F.col(url).alias("u"), F.col(bad).cast("double").alias("y"), buckets(host(F.col(url)), path(F.col(url)), dimensions).alias("b")).alias("r"))
    one = rows.agg(F.array_sort(F.collect_list("r")).alias("rows"))
    held = F.transform("rows", lambda r, i: F.struct(i.alias("i"), r["b"].alias("b")))
    one = one.withColumn("held", held)
    # for each weight the rows that have its bucket, so that a step only reads
    by = one.select(F.posexplode("held.b").alias("i", "bs")).select("i", F.size("bs").alias("k"), F.explode("bs").alias("b"))
    inverted = by.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("i", (1 / F.sqrt(F.col("k").cast("double"))).alias("x")))).alias("at"))
    all_ = labelled.sparkSession.range(dimensions).select(F.col("id").cast("int").alias("b"))
    inverse = all_.join(inverted, "b", "left").agg(F.array_sort(F.collect_list(F.struct("b", F.coalesce("at", F.array().cast("array<struct<i:int,x:double>>")).alias("at")))).alias("inv"))
    state = F.struct(F.array_repeat(F.lit(0.0), dimensions).alias("w"), F.lit(0.0).alias("c"), F.array().cast("array<double>").alias("e"))
    n = F.greatest(F.size("rows"), F.lit(1))

    def wrong(s):
        return F.struct(s["w"].alias("w"), s["c"].alias("c"), F.transform("rows", lambda r: _sigmoid(_score(r["b"], s["w"], s["c"])) - r["y"]).alias("e"))

    def moved(s):
        slope = lambda at: F.aggregate(at, F.lit(0.0), lambda a, p: a + F.element_at(s["e"], p["i"] + 1) * p["x"])
        w = F.zip_with(s["w"], F.col("inv"), lambda v, b: v - rate * (slope(b["at"]) / n + l2 * v))
        return F.struct(w.alias("w"), (s["c"] - rate * F.aggregate(s["e"], F.lit(0.0), lambda a, e: a + e) / n).alias("c"), s["e"].alias("e"))

    # each step is two: the errors are a value before the weights read them
    fit = F.aggregate(F.sequence(F.lit(1), F.lit(2 * steps)), state, lambda s, i: F.when(i % 2 == 1, wrong(s)).otherwise(moved(s)))
    both = one.select("rows", F.lit(1).alias("k")).join(inverse.withColumn("k", F.lit(1)), "k")
    got = both.select(fit.alias("m")).first()["m"]
    return [*got["w"], got["c"]]


def outputs(df: DataFrame) -> dict[str, str]:
    """The names that the columns of ``judge`` have beside those of ``df``."""
    return {n: fresh(df, n) for n in OUTPUTS}


def judge(df: DataFrame, model: list[float], url: str = "url", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """``df`` with ``_host``, ``_path``, ``_rule``, ``_score`` and ``_verdict``, or what ``outputs`` says where columns are so named; no shuffle."""
    names = outputs(df)
    rows = df.select(F.struct(*(F.col(c) for c in df.columns)).alias("row"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    weights = F.array(*(F.lit(float(w)) for w in model[:-1]))
    found = buckets(F.col("host"), F.col("path"), len(model) - 1)
    score = F.when(F.size(found) == 0, _sigmoid(F.lit(model[-1]))).otherwise(_sigmoid(_score(found, weights, F.lit(model[-1]))))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "score": score})
    made = {"_host": F.col("host"), "_path": F.col("path"), "_rule": F.col("rule"), "_score": F.col("score"), "_verdict": F.coalesce(verdict, F.when(F.col("score") > threshold, "block").otherwise("allow"))}
    return rows.select(*(F.col("row")[c].alias(c) for c in df.columns), *(made[n].alias(name) for n, name in names.items()))
