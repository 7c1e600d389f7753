"""Terms of deals from their texts: every statement becomes a row, rows are weighed, one is chosen or none.

``texts`` is (deal, text), any number of documents a deal. Statements are read
sentence by sentence; what several documents repeat counts more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.mergers import MONTHS

#: How far a stated price and premium may be from reproducing the offer; a class is nominal below this share of the best-paid one.
FIT, NOMINAL = 0.02, 0.01
#: Days around the agreement within which a value is of its day, and how old a close may be.
NEAR_DAYS, STALE_DAYS = 7, 5

_NUMBER = r"([0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)"
_MONEY = r"\$([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?)"
_DATE = rf"(?:{MONTHS}) [0-9]{{1,2}}, [0-9]{{4}}"


def sentences(texts: DataFrame) -> DataFrame:
    """(deal, s): sentences, spaces single; a null text has none."""
    plain = F.trim(F.regexp_replace("text", r"\s+", " "))
    return texts.select("deal", F.explode(F.split(plain, r'(?<=[.;!?]) (?=[A-Z"(])')).alias("s")).filter("s <> ''")


def _number(said: Column) -> Column:
    return F.replace(said, F.lit(","), F.lit("")).try_cast("double")


def _first(s: Column, pattern: str) -> Column:
    """The first match's first group; null if there is none."""
    return F.nullif(F.regexp_extract(s, pattern, 1), F.lit(""))


def _day(s: Column) -> Column:
    return F.try_to_date(_first(s, rf"({_DATE})"), "MMMM d, yyyy")


# Premiums

#: What a premium is measured to, told by its clause, first match first.
BASES = ((r"(?i)volume[- ]weighted|\bVWAP\b|average", "average"), (r"(?i)(?:52|fifty-two)[- ]week", "high"), (r"(?i)clos(?:e|ing)|unaffected|undisturbed|last (?:reported )?(?:sale|trading)", "close"))


def premium_statements(texts: DataFrame, offers: DataFrame) -> DataFrame:
    """(deal, basis, premium, price, date, proposal, names_offer, unaffected, days, digits, gap, offer): a row for each premium stated.

    ``offers`` is (deal, offer, agreed). A sentence with several premiums is read
    clause by clause, each from one percentage up to the next; a clause without a
    date has its sentence's.
    """
    percent = r"[0-9]+(?:\.[0-9]+)?(?:%| percent)"
    said = sentences(texts).filter(F.col("s").rlike(rf"(?i)premium|{percent} (?:above|over|higher than)"))
    clauses = said.select("deal", "s", F.explode(F.split("s", rf"(?=(?<![0-9.]){percent})")).alias("c")).filter(F.col("c").rlike(f"^{percent}")).join(offers, "deal")
    amounts = F.transform(F.regexp_extract_all("c", F.lit(_MONEY), 1), _number)
    others = F.filter(amounts, lambda a: F.abs(a - F.col("offer")) >= 0.005)
    basis = F.lit(None).cast("string")
    for pattern, name in reversed(BASES):
        basis = F.when(F.col("c").rlike(pattern), name).otherwise(basis)
    stated = F.regexp_extract("c", r"^([0-9.]+)", 1)
    rows = clauses.select(
        "deal", basis.alias("basis"), F.round(stated.cast("double") / 100, 6).alias("premium"), F.get(others, F.lit(0)).alias("price"), F.coalesce(_day(F.col("c")), _day(F.col("s"))).alias("date"),
        F.col("s").rlike("(?i)propos(?:al|ed)|indication of interest|initial bid|counteroffer").alias("proposal"), F.exists(F.transform(F.regexp_extract_all("s", F.lit(_MONEY), 1), _number), lambda a: F.abs(a - F.col("offer")) < 0.005).alias("names_offer"),
        F.col("c").rlike("(?i)unaffected|undisturbed|last (?:full )?trading day (?:before|prior)").alias("unaffected"), F.regexp_extract("c", r"(?i)([0-9]+)[- ](?:trading[- ])?day", 1).try_cast("int").alias("days"),
        F.length(F.regexp_extract(stated, r"\.([0-9]+)", 1)).alias("digits"), "offer", "agreed",
    )
    return rows.withColumn("gap", F.datediff("agreed", "date")).drop("agreed").filter("basis is not null")


def chosen_premiums(statements: DataFrame) -> DataFrame:
    """(deal, basis, premium, price, date, verdict, stated, refused): the deal's premium to each basis.

    A statement whose own price doesn't reproduce its premium with the offer to
    within two points is refused. Of the rest the order is: not of a proposal, naming the offer, to an
    unaffected price, with a price, with a date; then the most repeated, the one nearest before the agreement,
    the most precise, the lowest. verdict is "reproduced" or, without a price, "unchecked"; a basis all of whose
    statements are refused is "contradicted" and has no premium. Averages count if of thirty days.
    """
    s = statements.filter("basis <> 'average' OR days = 30")
    fits = F.abs(F.col("offer") / F.col("price") - 1 - F.col("premium")) <= FIT
    s = s.withColumn("verdict", F.when(F.col("price").isNull() | F.col("offer").isNull(), "unchecked").when(fits, "reproduced").otherwise("contradicted"))
    same = Window.partitionBy("deal", "basis", "premium", "verdict")
    s = s.withColumn("times", F.count("*").over(same))
    good = F.col("verdict") != "contradicted"
    before = F.when(F.col("gap") >= 0, -F.col("gap")).otherwise(F.lit(-(1 << 20)))
    worth = F.struct((~F.col("proposal")).alias("a"), F.col("names_offer").alias("b"), F.col("unaffected").alias("c"), F.col("price").isNotNull().alias("d"), F.col("date").isNotNull().alias("e"), F.col("times").alias("f"), before.alias("g"), F.col("digits").alias("h"), (-F.col("premium")).alias("i"), F.col("price").alias("j"), F.col("date").alias("k"))
    best = F.max_by(F.when(good, F.struct("premium", "price", "date", "verdict")), F.when(good, worth))
    g = s.groupBy("deal", "basis").agg(best.alias("x"), F.count("*").alias("stated"), F.count_if(~good).alias("refused"))
    return g.select("deal", "basis", "x.premium", "x.price", "x.date", F.coalesce("x.verdict", F.lit("contradicted")).alias("verdict"), "stated", "refused")


# Stock terms

RATIOS = (r"(?i)exchange ratio of ([0-9]+\.[0-9]+)", r"(?i)([0-9]+\.[0-9]+) (?:of a |of an |newly issued )?(?:ordinary |common )?(?:shares?|units?) of [A-Z]", r"(?i)converted into (?:the right to receive )?([0-9]+\.[0-9]+) shares?")
VALUES = (r"(?i)implied (?:value|consideration) of (?:approximately |about )?" + _MONEY, r"(?i)(?:total|aggregate) (?:value|consideration) of (?:approximately |about )?" + _MONEY + " per share", r"(?i)valued at (?:approximately |about )?" + _MONEY + " per share")


def _votes(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(deal, name): the value stated most often, the lesser of equals."""
    n = rows.filter(F.col(value).isNotNull()).groupBy("deal", value).agg(F.count("*").alias("n"))
    return n.groupBy("deal").agg(F.max_by(value, F.struct("n", -F.col(value))).alias(name))


def stock_values(texts: DataFrame, deals: DataFrame, closes: DataFrame) -> DataFrame:
    """(deal, ratio, cash, implied, method, date, unresolved): what a deal paid in stock is worth a share.

    ``deals`` is (deal, acquirer, agreed), ``closes`` (acquirer, day, close). In
    order: a value that the text states on a day near the agreement ("stated"),
    one it states on no day, its own sum of ratio times price and cash ("summed"), the ratio
    times the acquirer's last close on or before the agreement, at most five days old, and
    the cash ("priced"). A value on another day is no deal's. Where holders have
    depositary shares a value can't be told to be for one or for a share: "ads".
    Without a ratio or a value the terms are unknown: "terms"; without a close: "price".
    """
    s = sentences(texts)
    ratio = F.coalesce(*[_first(F.col("s"), p) for p in RATIOS]).cast("double")
    cash = F.coalesce(_first(F.col("s"), _MONEY + r" (?:per share )?in cash"), _first(F.col("s"), r"cash (?:consideration |payment )?of " + _MONEY))
    read = s.select(
        "deal", ratio.alias("ratio"), _number(cash).alias("cash"), _number(F.coalesce(*[_first(F.col("s"), p) for p in VALUES])).alias("value"), _day(F.col("s")).alias("date"),
        _first(F.col("s"), r"([0-9]+\.[0-9]+) (?:x|times|multiplied by) \$").cast("double").alias("by"), _number(_first(F.col("s"), r"(?:x|times|multiplied by) " + _MONEY)).alias("times"),
        _number(_first(F.col("s"), r"(?:plus|\+) " + _MONEY)).alias("plus"), F.col("s").rlike(r"\bADSs?\b|American Depositary").alias("ads"),
    )
    near = F.abs(F.datediff("date", "agreed")) <= NEAR_DAYS
    with_day = read.join(deals.select("deal", "agreed"), "deal")
    rank = F.when(F.col("value").isNotNull() & near, 0).when(F.col("value").isNotNull() & F.col("date").isNull(), 1).when(F.col("by").isNotNull() & F.coalesce(near, F.lit(True)), 2)
    value = F.when(rank < 2, F.col("value")).otherwise(F.col("by") * F.col("times") + F.coalesce("plus", F.lit(0.0)))
    said = with_day.withColumns({"rank": rank, "worth": value}).filter("rank is not null")
    said = said.groupBy("deal").agg(F.min_by(F.struct("worth", "rank", "date"), F.struct("rank", F.abs(F.datediff("date", "agreed")), "worth")).alias("x"))
    close = deals.join(closes, "acquirer").filter(F.datediff("agreed", "day").between(0, STALE_DAYS)).groupBy("deal").agg(F.max_by(F.struct("close", "day"), "day").alias("c"))
    flags = read.groupBy("deal").agg(F.bool_or("ads").alias("ads"))
    d = deals
    for other in (_votes(read, "ratio", "ratio"), _votes(read, "cash", "cash"), said, close, flags):
        d = d.join(other, "deal", "left")
    priced = F.col("ratio") * F.col("c.close") + F.coalesce("cash", F.lit(0.0))
    ads, stated = F.coalesce("ads", F.lit(False)), F.col("x").isNotNull()
    why = F.when(ads, "ads").when(~stated & F.col("ratio").isNull(), "terms").when(~stated & F.col("c").isNull(), "price")
    use = lambda x: F.when(why.isNull(), x)
    return d.select(
        "deal", "ratio", "cash", use(F.round(F.coalesce("x.worth", priced), 4)).alias("implied"), use(F.when(~stated, "priced").when(F.col("x.rank") < 2, "stated").otherwise("summed")).alias("method"),
        use(F.when(stated, F.col("x.date")).otherwise(F.col("c.day"))).alias("date"), why.alias("unresolved"),
    )


# Classes of shares

_CLASS = r"(Class [A-D]|Series [A-D]|[Cc]ommon|[Oo]rdinary|[Pp]referred)"


def class_name(said: Column) -> Column:
    """A class as its letter, or common, ordinary, preferred."""
    return F.lower(F.regexp_replace(said, "^(?:Class|Series) ", ""))


def class_statements(texts: DataFrame) -> DataFrame:
    """(deal, class, shares, price, bare): what a sentence says of a class: shares outstanding, or what each is paid, or that it has no economic interest."""
    s = sentences(texts)
    patterns = (
        (rf"(?i:{_NUMBER}) shares of {_CLASS}[A-Za-z ]*?(?:stock|shares)?(?: \([^)]*\))?,? (?:were |was |are )?(?:issued and )?outstanding", 1, 2),
        (rf"(?i:{_NUMBER}) {_CLASS}[A-Za-z ]*? ?(?:shares|stock)(?: were| are)? (?:issued and )?outstanding", 1, 2),
        (rf"{_CLASS}[A-Za-z ]*?(?:stock|shares)?: (?i:{_NUMBER})", 2, 1),
    )
    found = []
    for p, n, c in patterns:
        numbers, names = (F.regexp_extract_all("s", F.lit(p), g) for g in (n, c))
        found.append(F.zip_with(numbers, names, lambda a, b: F.struct(class_name(b).alias("class"), _number(a).alias("shares"), F.lit(None).cast("double").alias("price"), F.lit(False).alias("bare"))))
    # One payment may be for each share of several classes.
    paid = F.regexp_extract_all("s", F.lit(rf"((?i:each (?:outstanding )?share of)[^.;$]*?(?:right to receive|converted into|exchanged for) (?:an amount equal to )?{_MONEY})"), 1)
    named = lambda p: F.regexp_extract_all(p, F.lit(rf"(?i:share of) {_CLASS}"), 1)
    for_each = lambda p: F.transform(named(p), lambda c: F.struct(class_name(c).alias("class"), F.lit(None).cast("double").alias("shares"), _number(_first(p, _MONEY)).alias("price"), F.lit(False).alias("bare")))
    prices = F.flatten(F.transform(paid, for_each))
    bare = rf"{_CLASS}[^.;]*?(?:no economic (?:rights|interest)|not entitled to (?:any )?(?:dividends|consideration))"
    none = F.transform(F.regexp_extract_all("s", F.lit(bare), 1), lambda a: F.struct(class_name(a).alias("class"), F.lit(None).cast("double").alias("shares"), F.lit(None).cast("double").alias("price"), F.lit(True).alias("bare")))
    return s.select("deal", F.inline(F.concat(*found, prices, none)))


def share_counts(texts: DataFrame) -> DataFrame:
    """(deal, shares, classes, excluded, basis): the shares that a deal pays for, by class.

    Of a class's counts the most stated one holds, the greater of equals. Classes
    without economic interest, or paid less than a hundredth of the best-paid one, are nominal and excluded.
    If the consideration names classes with a count, those are summed ("considered"); else all but
    preferred ones ("all"). A deal without a count isn't returned.
    """
    st = class_statements(texts)
    votes = st.filter("shares is not null").groupBy("deal", "class", "shares").agg(F.count("*").alias("n"))
    counts = votes.groupBy("deal", "class").agg(F.max_by("shares", F.struct("n", "shares")).alias("shares"))
    pay = st.groupBy("deal", "class").agg(F.max("price").alias("price"), F.bool_or("bare").alias("bare"))
    best = Window.partitionBy("deal")
    c = counts.join(pay, ["deal", "class"]).withColumn("top", F.max("price").over(best))
    c = c.withColumn("out", F.col("bare") | F.coalesce(F.col("price") < NOMINAL * F.col("top"), F.lit(False)))
    c = c.withColumn("named", F.count(F.when(~F.col("out"), F.col("price"))).over(best) > 0)
    counted = ~F.col("out") & F.when(F.col("named"), F.col("price").isNotNull()).otherwise(F.col("class") != "preferred")
    names = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("class")))), ",")
    g = c.groupBy("deal").agg(F.sum(F.when(counted, F.col("shares"))).alias("shares"), names(counted).alias("classes"), names(F.col("out")).alias("excluded"), F.bool_or("named").alias("named"))
    return g.select("deal", "shares", "classes", "excluded", F.when(F.col("named"), "considered").otherwise("all").alias("basis"))
