"""Where a paper's PDF may be.

``lookups`` names the services to ask, a backend asks them (``backends.ask_services``), and ``candidates`` makes of
their answers a table of addresses by rank, all in expressions; fetching the first that works is a backend's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import stripped

# The public addresses of the services.
OPEN_ACCESS = "https://api.unpaywall.org/v2/"
CROSSREF = "https://api.crossref.org/works/"
PMC = "https://www.ncbi.nlm.nih.gov/pmc/articles/"
EUROPE_PMC = "https://europepmc.org/backend/ptpmcrender.fcgi?accid="
RESOLVER = "https://doi.org/"
ARCHIVE = "https://www.ncbi.nlm.nih.gov/pmc/utils/oa/oa.fcgi?id="
PMC_HOST = "pmc.ncbi.nlm.nih.gov"
# Seconds between requests, of hosts that ask for less than PAUSE.
PAUSE, PAUSES = 1.5, {"res.mdpi.com": 0.5, "europepmc.org": 1.0}


def clean_doi(doi: str | Column) -> Column:
    """A DOI without resolver addresses, wherever they stand, and without white space around it."""
    c = F.coalesce(F.col(doi) if isinstance(doi, str) else doi, F.lit(""))
    return stripped(F.replace(F.replace(c, F.lit("https://doi.org/"), F.lit("")), F.lit("http://doi.org/"), F.lit("")))


def cdn_url(url: str | Column) -> Column:
    """The publisher's CDN address of a file a-b-c.pdf; null for other names."""
    name = F.regexp_extract(F.rtrim(F.col(url) if isinstance(url, str) else url, F.lit("/")), r"[^/]*$", 0)
    slug = F.regexp_extract(name, r"(?s)^(.*)\.pdf$", 1)
    journal = F.regexp_extract(slug, r"(?s)^(.*)-[^-]*-[^-]*$", 1)
    fits = name.endswith(".pdf") & slug.rlike(r"(?s)^.*-[^-]*-[^-]*$")
    return F.when(fits, F.concat(F.lit("https://res.mdpi.com/"), journal, F.lit("/"), slug, F.lit("/article_deploy/"), slug, F.lit(".pdf")))


def open_access_urls(answer: str | Column) -> Column:
    """PDF addresses of an open-access answer (JSON), in its order; an unreadable answer has none."""
    parsed = F.from_json(answer, "oa_locations array<struct<url_for_pdf:string,url:string>>")
    urls = F.transform(parsed["oa_locations"], lambda x: F.coalesce(F.nullif(x["url_for_pdf"], F.lit("")), x["url"]))
    return F.coalesce(F.filter(urls, lambda u: u.isNotNull() & (u != "")), F.array().cast("array<string>"))


def crossref_urls(answer: str | Column) -> Column:
    """Addresses of a CrossRef answer (JSON) whose type or address has pdf in it."""
    parsed = F.from_json(answer, "message struct<link:array<struct<`content-type`:string,URL:string>>>")
    links = F.filter(parsed["message"]["link"], lambda x: F.lower(F.concat_ws(" ", x["content-type"], x["URL"])).contains("pdf"))
    return F.coalesce(F.transform(links, lambda x: x["URL"]), F.array().cast("array<string>"))


def archive_url(answer: str | Column) -> Column:
    """The address of the packed article in an archive service's answer (XML); null without one."""
    link = F.regexp_extract(answer, r"""<link\b[^>]*\bformat=["']tgz["'][^>]*>""", 0)
    return F.nullif(F.regexp_extract(link, r"""\bhref=["']([^"']+)["']""", 1), F.lit(""))


def lookups(papers: DataFrame, email: str) -> DataFrame:
    """(pmcid, doi, kind, url) of the services that know addresses; the open-access one asks for an e-mail address."""
    doi, has, own = clean_doi("doi"), clean_doi("doi") != "", F.coalesce("pmcid", F.lit("")) != ""
    kinds = F.array(
        F.struct(F.lit("open_access").alias("kind"), F.when(has, F.concat(F.lit(OPEN_ACCESS), doi, F.lit("?email="), F.lit(email))).alias("url")),
        F.struct(F.lit("crossref").alias("kind"), F.when(has, F.concat(F.lit(CROSSREF), doi)).alias("url")),
        F.struct(F.lit("archive").alias("kind"), F.when(own, F.concat(F.lit(ARCHIVE), F.col("pmcid"))).alias("url")),
    )
    return papers.select("pmcid", "doi", F.explode(kinds).alias("_c")).select("pmcid", "doi", "_c.*").filter("url is not null")


def direct_candidates(papers: DataFrame) -> DataFrame:
    """(pmcid, doi, rank, pos, kind, url) that need no lookup."""
    doi, has, own = clean_doi("doi"), clean_doi("doi") != "", F.coalesce("pmcid", F.lit("")) != ""
    kinds = F.array(
        F.struct(F.lit(3).alias("rank"), F.lit("pmc").alias("kind"), F.when(own, F.concat(F.lit(PMC), F.col("pmcid"), F.lit("/pdf/"))).alias("url")),
        F.struct(F.lit(4).alias("rank"), F.lit("europe_pmc").alias("kind"), F.when(own, F.concat(F.lit(EUROPE_PMC), F.col("pmcid"), F.lit("&blobtype=pdf"))).alias("url")),
        F.struct(F.lit(6).alias("rank"), F.lit("resolver").alias("kind"), F.when(has, F.concat(F.lit(RESOLVER), doi)).alias("url")),
    )
    rows = papers.select("pmcid", "doi", F.explode(kinds).alias("_c"))
    return rows.select("pmcid", "doi", "_c.rank", F.lit(0).alias("pos"), "_c.kind", "_c.url").filter("url is not null")


def candidates(papers: DataFrame, answers: DataFrame) -> DataFrame:
    """(pmcid, doi, rank, pos, kind, url) in the order in which they are tried.

    1 the open-access addresses, 2 the publisher's CDN for those of them at the archive that name a PDF, 3 and 4 the
    archive and its European mirror, 5 CrossRef's links, 6 the resolver, 7 the packed article. ``answers`` are
    (pmcid, doi, kind, answer); an answer that is absent or unreadable gives no address.
    """
    urls = F.when(F.col("kind") == "open_access", open_access_urls("answer")).when(F.col("kind") == "crossref", crossref_urls("answer")).when(archive_url("answer").isNotNull(), F.array(archive_url("answer")))
    rank = F.when(F.col("kind") == "open_access", 1).when(F.col("kind") == "crossref", 5).otherwise(7)
    told = answers.select("pmcid", "doi", rank.alias("rank"), "kind", F.posexplode(urls).alias("pos", "url")).select("pmcid", "doi", "rank", "pos", "kind", "url")
    cdn = told.filter((F.col("rank") == 1) & F.col("url").contains(PMC_HOST) & F.col("url").endswith(".pdf")).withColumns({"rank": F.lit(2), "kind": F.lit("cdn"), "url": cdn_url("url")})
    return told.unionByName(cdn.filter("url is not null")).unionByName(direct_candidates(papers))


def is_pdf(content: str | Column) -> Column:
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


def missing_pdfs(papers: DataFrame, listing: DataFrame) -> DataFrame:
    """Papers without a non-empty PDF in a ``binaryFile`` listing."""
    have = listing.filter("length > 0").select(F.regexp_extract("path", r"([^/]*)\.pdf$", 1).alias("pmcid")).distinct()
    return papers.join(have, "pmcid", "left_anti")
