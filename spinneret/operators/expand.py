"""URLs built from templates and search terms; extraction rules by site.

Templates and sites are configuration lists, so they are array literals that
each row explodes: no cross join and no shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.functions.urls import site_key
from spinneret.operators.joins import lookup_join

RULE_SCHEMA = "site string, follow boolean, pattern string, prefix string, templates array<string>"


def template_cross(urls: DataFrame, templates: list[str], url: str = "url") -> DataFrame:
    """Every template before every URL; ``template_no`` gives template-major order."""
    literals = F.array(*[F.lit(t) for t in templates])
    return urls.select("*", F.posexplode(literals).alias("template_no", "template")).select(
        *urls.columns,
        "template_no",
        F.concat("template", F.col(url)).alias("target"),
    )


def search_urls(terms: DataFrame, sites: dict[str, str], term: str) -> DataFrame:
    """Search URL per site and term; the term is form-encoded."""
    literals = F.array(
        *[
            F.struct(F.lit(name).alias("site"), F.lit(prefix).alias("prefix"))
            for name, prefix in sites.items()
        ]
    )
    return terms.select("*", F.explode(literals).alias("entry")).select(
        *terms.columns,
        F.col("entry.site").alias("site"),
        F.concat("entry.prefix", F.url_encode(F.col(term))).alias("search_url"),
    )


def site_rule(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Attach the extraction rule of a URL's site; NULLs where none is known."""
    return lookup_join(urls.withColumn("site", site_key(F.col(url))), rules, "site", "left")


def rule_targets(ruled: DataFrame, links: str) -> DataFrame:
    """For sites to follow: every template before every prefixed link."""
    followed = ruled.where(F.col("follow"))
    pages = followed.withColumn("_page", F.explode(links)).withColumn(
        "_page", F.concat("prefix", "_page")
    )
    kept = [c for c in ruled.columns if c not in (links, "templates", "follow", "pattern", "prefix")]
    return pages.select(
        *kept, "_page", F.posexplode("templates").alias("template_no", "_template")
    ).select(*kept, "template_no", F.concat("_template", "_page").alias("target"))
