"""Rule tables, read from the top: the first rule that matches wins. Written from the rule cards; all are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.rules import first_match
from tallyspark.functions.text import fold

#: Business lines of a posting, by its title.
VERTICALS = [
    (r"\bconsult(ing|ant)\b", "Consulting"),
    (r"\bquant(itative)?\b|\bsystematic\b", "Quant"),
    (r"\b(ai|ml|machine learning) research", "AI Research"),
    (r"\bdata (scien|engineer|analy)|\bmachine learning\b", "Data & ML"),
    (r"\bai engineer", "AI Engineering"),
    (r"\bequity research\b", "Equity Research"),
    (r"\bprivate equity\b|\bbuyout", "Private Equity"),
    (r"\bventure\b", "Venture Capital"),
    (r"\bprivate credit\b|\bdirect lending\b", "Private Credit"),
    (r"\bhedge fund\b", "Hedge Fund"),
    (r"\bwealth\b|\bprivate bank", "Wealth"),
    (r"\bretail bank|\bbranch\b", "Other"),
    (r"\bpayments?\b|\btreasury services\b|\bcorporate bank", "Corporate Banking"),
    (r"\bcustody\b|\bfund administration\b", "Operations"),
    (r"\breal estate\b", "Private Equity"),
    (r"\bvaluation\b|\btransformation\b", "Other"),
    (r"\binvestment bank|\bm&a\b|\bcapital markets\b", "Investment Banking"),
    (r"\bsales (&|and) trading\b|\btrad(er|ing)\b|\bmarkets\b", "Sales & Trading"),
    (r"\basset management\b|\bportfolio\b", "Asset Management"),
    (r"\bcorporate development\b", "Corporate Development"),
    (r"\bproduct (manager|owner)\b", "Product"),
    (r"\bsoftware\b|\bdeveloper\b|\bengineer", "Software"),
    (r"\brisk\b", "Risk"),
    (r"\bcompliance\b|\bfinancial crime\b", "Compliance"),
    (r"\bfinance\b|\baccount(ing|ant)\b|\baudit", "Finance & Accounting"),
    (r"\boperations\b", "Operations"),
]
#: How senior a posting is.
LEVELS = [
    (r"\b(managing director|partner|head of|chief)\b", "senior"),
    (r"\b(director|vice president|vp|principal)\b", "manager"),
    (r"\b(senior|sr|lead|manager)\b", "experienced"),
    (r"\b(spring|insight)\b", "insight"),
    (r"\b(intern(ship)?|summer|placement|off[- ]cycle)\b", "internship"),
    (r"\b(graduate|campus|entry|trainee|apprentice)", "graduate"),
    (r"\b(analyst|associate|junior)\b", "junior"),
]
#: Where a posting is, by city.
REGIONS = [
    (r"london|paris|frankfurt|zurich|madrid|milan|dublin|edinburgh", "Europe"),
    (r"new york|boston|chicago|san francisco|toronto", "Americas"),
    (r"hong kong|singapore|tokyo|sydney|mumbai|shanghai", "Asia-Pacific"),
    (r"dubai|riyadh|abu dhabi", "Middle East"),
]
#: Kinds of documents by title.
DOCUMENT_KINDS = [(r"fairness opinion", "opinion"), (r"\bannual (report|letter)\b", "annual"), (r"\b(q[1-4]|quarter(ly)?)\b", "quarterly"), (r"\bpresentation\b|\bdeck\b|discussion materials", "deck"), (r"\bletter\b", "letter")]
#: Titles that are no seats, what makes one a seat all the same, and what counts by its last mention only.
NOT_A_SEAT = r"\b(talent (pool|community|network)|expression of interest|register your interest|open day|webinar|info(rmation)? session|careers? fair|networking event)\b"
SEAT_ALL_THE_SAME = r"\b(recruiter|event manager|insight (week|programme|program))\b"
SEAT_OR_EVENT = r"\b(programme|internship|analyst|associate|event|webinar|session)\b"
EVENTS = ("event", "webinar", "session")
#: Tiers at which a junior title is an accepted seat.
JUNIOR_TIERS = ("trading", "quant")
#: Kinds of buyers by name: persons last.
BUYERS = [
    (r"\b(acquisition corp|merger sub|bidco|holdco|newco|topco|parent)\b", "vehicle"),
    (r"\b(capital partners|equity partners|private equity|buyout|growth fund|fund [ivx]+|capital management|partners l\.?p)\b", "sponsor"),
    (r"\b(inc|corp(oration)?|plc|ltd|limited|ag|se|nv|sa|company|co|group|holdings)\b", "strategic"),
    (r"^\p{Lu}\p{L}+( \p{Lu}\.?)? \p{Lu}\p{L}+$", "person"),
]
#: Filings by form alone: form, kind, confidence, reason.
FORMS = [
    (r"^10-[KQ]", "report", "high", "periodic report"),
    (r"^8-K", "report", "medium", "current report"),
    (r"^(DEFM|PREM)14", "solicitation", "high", "merger proxy"),
    (r"^(DEF|PRE)[ANC]?14", "solicitation", "medium", "proxy"),
    (r"^SC 13E", "schedule", "high", "going private"),
    (r"^SC 13[DG]|^SCHEDULE 13[DG]", "schedule", "medium", "beneficial ownership"),
    (r"^SC TO|^SC 14D9", "schedule", "high", "tender offer"),
]
#: Lookalike letters and the Latin ones they stand for.
LOOKALIKES = ("АВЕКМНОРСТХаеорсухіјѕΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXaeopcyxijsABEZHIKMNOPTYXo")
#: City codes of boards.
CITY_CODES = {"LDN": "London", "NYC": "New York", "HKG": "Hong Kong", "SGP": "Singapore", "FFM": "Frankfurt", "PAR": "Paris"}
ACRONYMS = frozenset("USA UK LLC LLP LP PLC AG SE NV SA II III IV ETF REIT IT HSBC UBS IBM".split())
SMALL_WORDS = frozenset("of the and for in on at by to a an de la du von".split())


def vertical(title: Column) -> Column:
    return first_match(title, VERTICALS, "Other")


def level(title: Column) -> Column:
    return first_match(title, LEVELS)


def region(place: Column) -> Column:
    return first_match(place, REGIONS)


def is_seat(title: Column) -> Column:
    """Whether a title is a role: no placeholder or attendance, or one that names a person's job; of mixed titles the last mention counts."""
    mentions = F.regexp_extract_all(F.lower(title), F.lit(SEAT_OR_EVENT), 1)
    last = F.element_at(mentions, F.when(F.size(mentions) > 0, F.size(mentions)))
    screened = title.rlike(f"(?i){NOT_A_SEAT}") | F.coalesce(last.isin(*EVENTS), F.lit(False))
    return ~screened | title.rlike(f"(?i){SEAT_ALL_THE_SAME}")


def admitted(title: Column, campus: Column, tier: Column) -> Column:
    """Why a posting is refused, or null: no seat, senior, manager, experienced without campus, junior at another tier than trading or quant."""
    lv = level(title)
    return (
        F.when(~is_seat(title), "not a seat")
        .when(lv.isin("senior", "manager"), lv)
        .when((lv == "experienced") & ~campus, "experienced")
        .when(title.rlike(r"(?i)\bjunior\b") & ~F.coalesce(tier.isin(*JUNIOR_TIERS), F.lit(False)), "junior")
    )


def by_form(form: Column) -> Column:
    """struct(kind, confidence, reasons) of a filing by its form alone; none has low confidence."""
    out = None
    for pattern, kind, confidence, reason in FORMS:
        found = F.struct(F.lit(kind).alias("kind"), F.lit(confidence).alias("confidence"), F.array(F.lit(reason)).alias("reasons"))
        out = F.when(form.rlike(pattern), found) if out is None else out.when(form.rlike(pattern), found)
    return out.otherwise(F.struct(F.lit("other").alias("kind"), F.lit("low").alias("confidence"), F.array(F.lit("form not listed")).alias("reasons")))


def latin_lookalikes(text: Column) -> Column:
    return F.translate(text, *LOOKALIKES)


def location(city: Column, area: Column, country: Column) -> Column:
    """'City, Area, Country' of the parts that there are, city codes spelled out, a part that repeats the one before left out."""
    table = F.create_map(*[F.lit(x) for pair in CITY_CODES.items() for x in pair])
    named = F.coalesce(F.element_at(table, F.upper(F.trim(city))), F.trim(city))
    parts = F.filter(F.array(named, F.trim(area), F.trim(country)), lambda p: p.isNotNull() & (p != ""))
    return F.array_join(F.array_distinct(parts), ", ")


def pretty_name(name: Column) -> Column:
    """Words capitalised; acronyms and words without a vowel upper, small words lower but for the first."""
    words = F.split(F.trim(F.regexp_replace(name, r"\s+", " ")), " ")

    def shown(w: Column, i: Column) -> Column:
        bare = F.upper(F.regexp_replace(w, r"[.,]", ""))
        whole = F.upper(w)
        return (
            F.when(bare.isin(*sorted(ACRONYMS)) | (~bare.rlike("[AEIOUY]") & bare.rlike("^[A-Z]{2,4}$")), whole)
            .when((i > 0) & F.lower(w).isin(*sorted(SMALL_WORDS)), F.lower(w))
            .otherwise(F.concat(F.substring(whole, 1, 1), F.lower(F.substr(w, F.lit(2)))))
        )

    return F.array_join(F.transform(words, shown), " ")


def same_company(a: Column, b: Column) -> Column:
    """Names equal without legal endings, or one edit apart when six letters or longer."""
    from tallyspark.functions.text import company_core

    x, y = company_core(a), company_core(b)
    return (x != "") & ((x == y) | ((F.least(F.length(x), F.length(y)) >= 6) & (F.levenshtein(x, y) <= 1)))


def same_registrant(a: Column, b: Column) -> Column:
    """Names equal letter by letter but for case, marks and spacing: legal endings count."""
    return (fold(a) != "") & (fold(a) == fold(b))
