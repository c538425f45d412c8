"""Publication dates by independent witnesses (T1 to T5, F4), in column expressions.

Witnesses: U, the date in the URL's path; H, one in the page's markup; T, a dateline at the start of the text; C, the crawler's own.
Dates are texts, YYYY-MM-DD or, where only a month is known, YYYY-MM. Later ones than `today` are no witnesses. Null or empty inputs
witness nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Path parts and last segments of index pages.
INDEX_PARTS = "tag tags category categories label author authors topic topics section archive archives search page".split()
INDEX_ENDS = "news media press press-releases news-releases releases blog newsroom latest archive".split()
MONTHS = "january february march april may june july august september october november december".split()
_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if m != "may" else m for m in MONTHS)


def _path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def _query(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1))


def is_article_url(url: Column) -> Column:
    """A last segment of six words, or of three below a year and month."""
    path = F.lower(F.rtrim(_path(url), F.lit("/")))
    words = F.size(F.filter(F.split(F.substring_index(path, "/", -1), "[-_]+"), lambda w: w != ""))
    return (words >= 6) | ((words >= 3) & F.concat(path, F.lit("/")).rlike(r"/(?:19|20)\d\d/\d\d?/"))


def is_listing(url: Column) -> Column:
    path = F.lower(F.rtrim(_path(url), F.lit("/")))
    last = F.substring_index(path, "/", -1)
    index = (path == "") | F.concat(path, F.lit("/")).rlike(f"/(?:{'|'.join(INDEX_PARTS)})/") | _query(url).rlike(r"(?:^|&)(?:page|start|offset|l|p|pg)=\d") | last.isin(*INDEX_ENDS) | last.endswith("-in-media")
    return ~is_article_url(url) & index


def is_listing_doc(url: Column, text: Column) -> Column:
    """An index page by its URL, or by five teasers' ellipses."""
    teasers = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"(?<!\.)(?:…|\.\.\.)(?![.…])"))
    return is_listing(url) | (~is_article_url(url) & (teasers >= 5))


def _day(y: Column, m: Column, d: Column, today: Column) -> Column:
    date = F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    return F.when(date <= today, F.date_format(date, "yyyy-MM-dd"))


def _groups(c: Column, pattern: str, n: int) -> list[Column]:
    return [F.when(c.rlike(pattern), F.regexp_extract(c, pattern, i + 1)) for i in range(n)]


def url_date(url: Column, today: Column) -> Column:
    path = _path(url)
    split = r"(?<!\d)(20[0-3]\d|199\d)[/_-](0?[1-9]|1[0-2])[/_-](0?[1-9]|[12]\d|3[01])(?!\d)"
    joined = r"(?<!\d)(20[0-3]\d)(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])(?!\d)"
    month = r"/(20[0-3]\d|199\d)/(0[1-9]|1[0-2])/"
    y, m = _groups(path, month, 2)
    only_month = F.when(F.try_to_date(F.concat_ws("-", y, m, F.lit("01")), "yyyy-MM-dd") <= today, F.concat_ws("-", y, m))
    return F.when(path.rlike(split), _day(*_groups(path, split, 3), today)).when(path.rlike(joined), _day(*_groups(path, joined, 3), today)).when(path.rlike(month), only_month)


def html_date(html: Column, today: Column) -> Column:
    """Of the markup's publication date: meta elements, structured data, then the first time element. Links to the page itself don't count."""
    page = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), r"""(?i)<link[^>]+rel=["']?canonical[^>]*>""", " "), r"(?i)<meta[^>]+(?:og:url|twitter:url)[^>]*>", " ")
    day = r"(\d{4})-(\d{2})-(\d{2})"
    names = "article:published_time|datepublished|date|dc.date|dcterms.created|pubdate|publish-date|publication_date"
    forms = [
        rf"""(?i)<meta[^>]+(?:name|property|itemprop)=["']?(?:{names})["']?[^>]*content=["']?{day}""",
        rf"""(?i)<meta[^>]+content=["']?{day}[^>]*(?:name|property|itemprop)=["']?(?:{names})["']?""",
        rf"""(?i)"datePublished"\s*:\s*"{day}""",
        rf"""(?i)<time[^>]+datetime=["']?{day}""",
    ]
    return F.coalesce(*[_day(*_groups(page, f, 3), today) for f in forms])


def text_date(text: Column, today: Column) -> Column:
    """The first full date in the opening 500 characters: 12 March 2024, March 12, 2024, 2024-03-12 or 12.03.2024; from 1995 on."""
    head = F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 500))
    number = lambda m: F.coalesce(*[F.when(F.substring(m, 1, 3) == x[:3], F.lit(str(i))) for i, x in enumerate(MONTHS, 1)])
    forms = {
        rf"(?<!\d)(\d{{1,2}})(?:st|nd|rd|th)?\.? (?:of )?({_MONTH})\.?,? (\d{{4}})(?!\d)": lambda d, m, y: (y, number(m), d),
        rf"\b({_MONTH})\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?!\d)": lambda m, d, y: (y, number(m), d),
        r"(?<!\d)(\d{4})-(\d{2})-(\d{2})(?!\d)": lambda y, m, d: (y, m, d),
        r"(?<!\d)(\d{1,2})\.(\d{1,2})\.(\d{4})(?!\d)": lambda d, m, y: (y, m, d),
    }
    found = []
    for pattern, order in forms.items():
        day = _day(*order(*_groups(head, pattern, 3)), today)
        found.append(F.when(day >= "1995-01-01", F.struct(F.regexp_instr(head, F.lit(pattern)).alias("at"), day.alias("day"))))
    return F.array_min(F.array_compact(F.array(*found)))["day"]


def resolve(docs: DataFrame, today: Column | None = None) -> DataFrame:
    """docs (url, text, html, published_at, fetched_at, as texts) with date, status and witnesses (struct<U, H, T, C>).

    The day with most witnesses wins; ties go to U, then H, T, C. The crawler's date is refused if it is the day of fetching and nobody
    agrees. Without a day, months are counted the same way. Index pages have no date.
    """
    today = F.current_date() if today is None else today
    w = {"U": url_date(F.col("url"), today), "H": html_date(F.col("html"), today), "T": text_date(F.col("text"), today)}
    crawled = F.nullif(F.substring(F.coalesce("published_at", F.lit("")), 1, 10), F.lit(""))
    crawled = F.when(crawled <= F.date_format(today, "yyyy-MM-dd"), crawled)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in w.items()], crawled.alias("given"), is_listing_doc(F.col("url"), F.col("text")).alias("listing"))
    alone = ~F.coalesce(F.array_contains(F.array("U", "H", "T"), F.col("given")), F.lit(False))
    refused = (F.col("given") == F.substring(F.coalesce("row.fetched_at", F.lit("")), 1, 10)) & alone
    rows = rows.withColumn("C", F.when(~F.coalesce(refused, F.lit(False)), F.col("given")))
    names = ["U", "H", "T", "C"]

    def voted(values: list[Column]) -> Column:
        """The value with most votes, and their number; ties in order."""
        one = [F.when(v.isNotNull(), F.struct(sum((F.coalesce(v == x, F.lit(False)).cast("int") for x in values[1:]), F.coalesce(v == values[0], F.lit(False)).cast("int")).alias("n"), F.lit(-i).alias("o"), v.alias("v"))) for i, v in enumerate(values)]
        return F.array_max(F.array_compact(F.array(*one)))

    day = voted([F.when(F.length(n) == 10, F.col(n)) for n in names])
    month = voted([F.substring(n, 1, 7) for n in names])
    rows = rows.withColumns({"day": day, "month": month})
    proven = (F.col("day.n") >= 2) | F.coalesce(F.col("day.v") == F.col("U"), F.lit(False))
    date = F.when(F.col("listing"), None).otherwise(F.coalesce("day.v", "month.v"))
    status = F.when(F.col("listing"), "listing").when(F.col("day").isNotNull(), F.when(proven, "proven").otherwise("single")).when(F.col("month").isNotNull(), F.when(F.col("month.n") >= 2, "proven-month").otherwise("single-month")).otherwise("undated")
    own = {"date": date, "status": status, "witnesses": F.when(~F.col("listing"), F.struct(*names))}
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in own], *[c.alias(n) for n, c in own.items()])
