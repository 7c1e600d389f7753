"""Job boards as they landed: each family's records in one common shape, and the boards that a page links to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import text
from tallyspark.functions.rules import first_match

PLACE = "struct<city: string, region: string, province: string, name: string, country: string, fullLocation: string, remote: boolean, hidden: boolean>"
LABEL = "struct<label: string>"


def _stated(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def _joined(*parts: Column, by: str = ", ") -> Column:
    """The parts that say something, each once, in order."""
    return F.array_join(F.array_distinct(F.array_compact(F.array(*[_stated(p) for p in parts]))), by)


def _places(listed: Column, otherwise: Column) -> Column:
    each = F.transform(F.filter(listed, lambda p: ~F.coalesce(p["hidden"], F.lit(False))), lambda p: _joined(p["city"], p["country"]))
    joined = F.array_join(F.array_distinct(F.filter(each, lambda x: x != "")), "; ")
    return F.coalesce(F.nullif(joined, F.lit("")), otherwise)


def _or_remote(place: Column, remote: Column) -> Column:
    return F.when(~F.coalesce(remote, F.lit(False)), place).when(place == "", "Remote").otherwise(F.concat(place, F.lit(" (Remote)")))


def _oracle(r: Column, board: Column, host: Column) -> dict[str, Column]:
    return {
        "id": r["Id"], "title": r["Title"], "location": r["PrimaryLocation"], "department": r["JobFamily"], "posted": r["PostedDate"], "deadline": r["PostingEndDate"],
        "url": F.concat(F.lit("https://"), host, F.lit("/hcmUI/CandidateExperience/en/sites/"), board, F.lit("/job/"), r["Id"]),
        "description": F.concat_ws(" ", _stated(r["ShortDescriptionStr"]), _stated(r["ExternalQualificationsStr"]), _stated(r["ExternalResponsibilitiesStr"])),
    }


def _eightfold(r: Column, board: Column, host: Column) -> dict[str, Column]:
    at = F.coalesce(r["t_create"], r["t_update"])  # seconds; what isn't a day of these years, milliseconds say, is no time
    first, after = (F.unix_timestamp(F.lit(f"{year}-01-01"), "yyyy-MM-dd") for year in (1990, 2100))
    return {
        "id": F.coalesce(r["id"], r["ats_job_id"], r["display_job_id"]), "title": F.coalesce(r["name"], r["posting_name"]),
        "location": F.coalesce(r["location"], F.array_join(r["locations"], ", ")), "department": F.coalesce(_stated(r["department"]), r["business_unit"]),
        "url": F.coalesce(r["canonicalPositionUrl"], F.concat(F.lit("https://"), host, F.lit("/careers/job/"), r["id"])),
        "posted": F.when(at.between(first, after), F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")), "description": r["job_description"],
    }


def _smartrecruiters(r: Column, board: Column, host: Column) -> dict[str, Column]:
    own = F.coalesce(r["company"]["identifier"], board)
    place = r["location"]
    stated = _or_remote(_joined(place["city"], place["region"], place["country"]), place["remote"])
    return {
        "id": F.when(F.lower(own) == F.lower(board), r["id"]), "title": r["name"], "location": F.coalesce(_stated(place["fullLocation"]), stated),
        "url": F.concat(F.lit("https://jobs.smartrecruiters.com/"), F.url_encode(own), F.lit("/"), F.url_encode(r["id"])),
        "department": F.coalesce(_stated(r["department"]["label"]), r["function"]["label"]), "posted": r["releasedDate"],
    }


def _recruitee(r: Column, board: Column, host: Column) -> dict[str, Column]:
    word = F.lower(F.regexp_extract(r["title"], "[A-Za-z]+", 0))
    open_ = (F.coalesce(r["status"], F.lit("published")) == "published") & (word != "closed")
    own = F.lower(F.coalesce(_stated(r["company_name"]), board)) == F.lower(board)
    stated = F.trim(r["published_at"])
    at = F.coalesce(F.try_to_timestamp(stated, F.lit("yyyy-MM-dd HH:mm:ss 'UTC'")), F.try_to_timestamp(stated))
    return {
        "id": F.when(open_ & own, r["id"]), "title": r["title"], "url": F.coalesce(_stated(r["careers_url"]), r["careers_apply_url"]), "department": r["department"], "deadline": r["close_at"],
        "location": _places(r["locations"], F.coalesce(F.nullif(_joined(r["city"], r["country"]), F.lit("")), F.trim(r["location"]))),
        "posted": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "description": F.concat_ws(" ", r["description"], r["requirements"]),
    }


def _pinpoint(r: Column, board: Column, host: Column) -> dict[str, Column]:
    place = r["location"]
    return {
        "id": r["id"], "title": r["title"], "url": r["url"], "location": _joined(place["city"], place["province"], place["name"]),
        "department": r["job"]["department"]["name"], "deadline": r["deadline_at"],
        "description": F.concat_ws(" ", _stated(r["description"]), _stated(r["key_responsibilities"]), _stated(r["skills_knowledge_expertise"])),
    }


def _workable(r: Column, board: Column, host: Column) -> dict[str, Column]:
    return {
        "id": F.coalesce(_stated(r["shortcode"]), r["id"]), "title": r["title"], "url": F.coalesce(_stated(r["url"]), _stated(r["shortlink"]), r["application_url"]),
        "location": _or_remote(_places(r["locations"], _joined(r["city"], r["country"])), r["telecommuting"]),
        "department": r["department"], "posted": F.coalesce(_stated(r["published_on"]), r["created_at"]),
    }


#: Each family: where a board's answer lists its postings, the fields of one, and its common shape. The names of fields are
#: fixed values: they are those of the boards' answers.
FAMILIES = {
    "oracle": ("$.items", "Id string, Title string, PrimaryLocation string, JobFamily string, PostedDate string, PostingEndDate string, ShortDescriptionStr string, ExternalQualificationsStr string, ExternalResponsibilitiesStr string", _oracle),
    "eightfold": ("$.positions", "id string, ats_job_id string, display_job_id string, name string, posting_name string, location string, locations array<string>, canonicalPositionUrl string, department string, business_unit string, t_create double, t_update double, job_description string", _eightfold),
    "smartrecruiters": ("$.content", f"id string, name string, company struct<identifier: string>, location {PLACE}, department {LABEL}, function {LABEL}, releasedDate string", _smartrecruiters),
    "recruitee": ("$.offers", f"id string, title string, status string, company_name string, careers_url string, careers_apply_url string, department string, close_at string, published_at string, city string, country string, location string, locations array<{PLACE}>, description string, requirements string", _recruitee),
    "pinpoint": ("$.data", f"id string, title string, url string, location {PLACE}, job struct<department: struct<name: string>>, deadline_at string, description string, key_responsibilities string, skills_knowledge_expertise string", _pinpoint),
    "workable": ("$.jobs", f"id string, shortcode string, title string, url string, shortlink string, application_url string, city string, country string, locations array<{PLACE}>, telecommuting boolean, department string, published_on string, created_at string", _workable),
}
FIELDS = ("id", "title", "location", "url", "department", "posted", "deadline", "description")
#: Families whose postings are listed once for each city.
LISTED_BY_CITY = ("workable",)


def jobs(boards: DataFrame) -> DataFrame:
    """The postings of boards (family, board, host, value) as (family, board, id, title, location, url, department, posted, deadline, description).

    ``value`` is a board's whole answer. A posting without id, title or link, or
    of another company's, is left out, and so is an unknown family; an answer
    that can't be read gives no rows. A posting listed again for another city is
    one job with all its cities.
    """
    found = None
    for family in FAMILIES:
        rows = _jobs_of(boards, family)
        rows = _one_for_all_cities(rows) if family in LISTED_BY_CITY else rows.drop("k")
        found = rows if found is None else found.unionByName(rows)
    return found


def _jobs_of(boards: DataFrame, family: str) -> DataFrame:
    """A family's postings; the filter reaches the scan, so boards stored by family are read once in all."""
    path, schema, to_job = FAMILIES[family]
    listed = F.from_json(F.get_json_object("value", path), "array<string>")
    each = boards.filter(F.col("family") == family).select("board", "host", F.posexplode(listed).alias("k", "r"))
    said = to_job(F.col("r"), F.col("board"), F.col("host"))
    fields = {f: said.get(f, F.lit(None)).cast("string") for f in FIELDS}
    fields |= {f: F.trim(fields[f]) for f in ("id", "title")} | {f: F.coalesce(fields[f], F.lit("")) for f in ("location", "description")}
    rows = each.withColumn("r", F.from_json("r", schema)).select(F.lit(family).alias("family"), "board", "k", *[c.alias(f) for f, c in fields.items()])
    return rows.filter("id <> '' and title <> '' and url <> ''")


def _one_for_all_cities(rows: DataFrame) -> DataFrame:
    key = ["family", "board", "id"]
    others = [f for f in FIELDS if f not in ("id", "location")]
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*others), "k").alias("job"))
    places = rows.select(*key, "k", F.posexplode(F.split("location", "; ")).alias("j", "place")).groupBy(*key, "place").agg(F.min(F.struct("k", "j")).alias("at"))
    joined = places.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("at", "place"))).alias("p"))
    joined = joined.select(*key, F.array_join(F.filter(F.transform("p", lambda x: x["place"]), lambda x: x != ""), "; ").alias("location"))
    return first.join(joined, key).select(*key, "location", *[F.col("job")[f].alias(f) for f in others])


#: Hosts of board families; fixed names.
HOSTS = [
    (r"\.myworkdayjobs\.", "workday"), (r"greenhouse\.io", "greenhouse"), (r"lever\.co", "lever"), (r"ashbyhq\.com", "ashby"), (r"oraclecloud\.com", "oracle"),
    (r"eightfold\.ai", "eightfold"), (r"smartrecruiters\.com", "smartrecruiters"), (r"recruitee\.com", "recruitee"), (r"pinpointhq\.com", "pinpoint"), (r"workable\.com", "workable"),
]
#: Words of a site's path that speak for first jobs, and for later ones.
FIRST_JOBS = ("campus", "early", "graduate", "graduates", "intern", "interns", "internships", "student", "students", "university")
LATER_JOBS = ("alumni", "experienced", "lateral", "laterals", "professional", "professionals")


def board_of_page(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, family, url): the board that each page links to, absolutely or without a protocol; none, no row.

    A campus site of the first family comes first, then one that isn't for
    lateral hires, then any of that family, then the first of any other.
    """
    urls = F.regexp_extract_all(F.col(html), F.lit(r"""((?:https?:)?//[A-Za-z0-9-][^\s"'<>()\\]*)"""), 1)
    each = pages.select(key, F.posexplode(urls).alias("__k", "url")).withColumn("url", F.when(F.col("url").startswith("//"), F.concat(F.lit("https:"), F.col("url"))).otherwise(F.col("url")))
    host = F.regexp_extract("url", "^https?://([^/?#]*)", 1)
    found = each.withColumn("family", first_match(host, HOSTS)).filter("family is not null")
    words = F.split(F.lower(F.regexp_replace("url", "^https?://[^/?#]*", "")), "[^a-z]+")
    has = lambda listed: F.arrays_overlap(words, F.array(*[F.lit(w) for w in listed])).cast("int")
    worth = (F.col("family") == HOSTS[0][1]).cast("int") * (1 + (1 - has(LATER_JOBS)) + 2 * has(FIRST_JOBS))
    best = found.groupBy(key).agg(F.max_by(F.struct("family", "url"), F.struct(worth, -F.col("__k"))).alias("b"))
    return best.select(key, "b.family", "b.url")


#: Words of firms' names that their boards leave out, besides legal endings.
TRADE_WORDS = ("advisers", "advisors", "asset", "associates", "bank", "capital", "investments", "management", "partners", "securities")


def guessed_tokens(name: Column) -> Column:
    """Board tokens that a firm of this name might use, each once and over two letters long.

    The whole name run together and with dashes, its first word, and what is left
    without legal endings and words of the trade.
    """
    words = F.split(text.fold(name), " ")
    common = F.array(*[F.lit(w) for w in (*text.COMPANY_SUFFIXES.split("|"), *TRADE_WORDS)])
    own = F.filter(words, lambda w: ~F.array_contains(common, w))
    tokens = F.array(F.array_join(words, ""), F.array_join(words, "-"), F.get(words, F.lit(0)), F.array_join(own, ""))
    return F.array_distinct(F.filter(tokens, lambda t: F.length(t) > 2))
