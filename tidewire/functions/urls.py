"""Columns over URLs: parts, checks, normal form, keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.config import BAD_HOSTS, SCHEMES

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def text(url: Column) -> Column:
    """The URL without leading blanks and without tabs and line ends; empty for null."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(text(url), SCHEME, 1))


def _rest(url: Column) -> Column:
    return F.regexp_replace(text(url), SCHEME, "")


def netloc(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^//([^/?#]*)", 1)


def _host_port(url: Column) -> Column:
    return F.regexp_replace(netloc(url), r"^.*@", "")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _host_of(hp: Column) -> Column:
    bracketed = F.startswith(hp, F.lit("["))
    return F.lower(F.when(bracketed, F.regexp_extract(hp, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_extract(hp, r"^([^:]*)", 1)))


def host(url: Column) -> Column:
    """The host in lower case, empty if there is none."""
    return _let(_host_port(url), _host_of)


def url_fqdn(url: Column) -> Column:
    """The host in lower case, null if there is none."""
    return F.nullif(host(url), F.lit(""))


def _odd(net: Column) -> Column:
    """Brackets that don't pair up, or hold no address, or stand behind other text."""
    hp = F.regexp_replace(net, r"^.*@", "")
    both = net.contains("[") & net.contains("]")
    address = F.startswith(hp, F.lit("[")) & F.lower(F.regexp_extract(hp, r"^\[([^\]]*)\]", 1)).rlike(r"^(?:[0-9a-f:.]+|v.*)$")
    return (net.contains("[") != net.contains("]")) | (both & ~address)


def is_bad(url: Column) -> Column:
    return _let(netloc(url), _odd)


def in_domains(name: Column, domains: Sequence[str]) -> Column:
    """Whether a host is one of the domains or below one, at a label's edge."""
    if not domains:
        return F.lit(False)
    return F.exists(F.array(*[F.lit(d) for d in domains]), lambda d: (name == d) | F.endswith(name, F.concat(F.lit("."), d)))


def suffixes(name: Column) -> Column:
    """The host and all domains above it, for joins with a large list."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def non_news(df: DataFrame, name: str, excluded: DataFrame, domain: str = "domain") -> DataFrame:
    """Add is_non_news by a join with a list of any size: rows whose host or a domain above it is listed."""
    listed = excluded.select(F.col(domain).alias("__suffix")).distinct()
    hosts = df.select(F.col(name).alias("__host")).where("__host is not null").distinct()
    hit = hosts.withColumn("__suffix", F.explode(suffixes(F.col("__host")))).join(listed, "__suffix", "left_semi").select("__host").distinct()
    joined = df.join(hit.withColumn("__hit", F.lit(True)), df[name] == hit["__host"], "left")
    return joined.withColumn("is_non_news", F.coalesce("__hit", F.lit(False))).drop("__host", "__hit")


def check_url(url: Column, excluded: Sequence[str] = ()) -> Column:
    """Why a URL is refused, null if it isn't; the order of the tests is part of the contract."""

    def faults(p: Column) -> Column:
        return (
            F.when(F.coalesce(p["url"], F.lit("")) == "", "no-url")
            .when(p["bad"], "bad-url")
            .when(p["host"] == "", "no-host")
            .when(~p["scheme"].isin(*SCHEMES), "bad-scheme")
            .when(in_domains(p["host"], excluded), "non-news")
            .when(p["host"].isin(*BAD_HOSTS), "bad-host")
        )

    parts = F.struct(url.alias("url"), scheme(url).alias("scheme"), host(url).alias("host"), is_bad(url).alias("bad"))
    return _let(parts, faults)


def filter_domains(df: DataFrame, urls: Sequence[str], include: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> DataFrame:
    """Rows of which any URL is in the included domains, or none in the excluded ones; give one list only."""
    if (include is None) == (exclude is None):
        raise ValueError("give either include or exclude")
    domains = include if include is not None else exclude
    hit = F.lit(False)
    for u in urls:
        hit = hit | (~is_bad(F.col(u)) & in_domains(host(F.col(u)), domains))
    return df.where(hit if include is not None else ~hit)


def classify_redirects(chain: Column, excluded: Sequence[str], limit: int = 30) -> Column:
    """The first fault of a redirect chain (an array of next URLs), null if it ends well."""

    def fault(url, i):
        return (
            F.when(F.coalesce(url, F.lit("")) == "", "badredir")
            .when(i + 1 >= limit, "maxredir")
            .when(host(url) == "", "badredir2")
            .when(in_domains(host(url), excluded), "non-news2")
        )

    return F.get(F.filter(F.transform(chain, fault), lambda x: x.isNotNull()), F.lit(0))


#: Codes of responses that name another URL.
REDIRECTS = (301, 302, 303, 307, 308)


def classify_redirects_registered(df: DataFrame, listed: DataFrame, public_suffixes: Sequence[str], url: str = "url", location: str = "location", status: str = "status") -> DataFrame:
    """Add target (location made absolute), registered (its registered domain) and dropped: a redirect, by its
    code, to a domain of `listed` (column registered). The list may be long, so it is joined; other codes
    and rows without a location go through."""
    listed = listed.select(F.col("registered").alias("__listed")).distinct()
    rows = df.withColumn("target", resolve(F.col(url), F.col(location)))
    rows = rows.withColumn("registered", registered_domain(host(F.col("target")), public_suffixes))
    moved = F.coalesce(F.col(status).isin(*REDIRECTS), F.lit(False))
    rows = rows.join(listed, rows["registered"] == listed["__listed"], "left")
    return rows.withColumn("dropped", moved & F.col("__listed").isNotNull()).drop("__listed")


def resolve(base: Column, target: Column) -> Column:
    """A redirect target made absolute: //host/path and /path and path forms."""
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    folder = F.regexp_replace(F.regexp_extract(_rest(base), r"^//[^/?#]*([^?#]*)", 1), r"[^/]*$", "")
    return (
        F.when(scheme(target) != "", target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme(base), F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def registered_domain(host: Column, public_suffixes: Sequence[str]) -> Column:
    """One label more than the longest listed suffix; without a listed one the last label is the suffix."""
    listed = F.array(*[F.lit(s) for s in public_suffixes]) if public_suffixes else F.array().cast("array<string>")

    def of(name: Column) -> Column:
        labels = F.split(name, r"\.")
        found = F.filter(listed, lambda s: F.endswith(name, F.concat(F.lit("."), s)))
        depth = F.coalesce(F.array_max(F.transform(found, lambda s: F.size(F.split(s, r"\.")))), F.lit(1))
        n = F.least(depth + 1, F.size(labels))
        return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")

    return _let(host, of)


def canonical_domain(url: Column, public_suffixes: Sequence[str]) -> Column:
    return registered_domain(host(url), public_suffixes)


def is_homepage(url: Column) -> Column:
    tail = F.regexp_extract(_rest(url), r"^//[^/?#]*(.*)$", 1)
    return F.regexp_replace(tail, "#.*$", "").rlike(r"^(?:/?|/index\.[A-Za-z]+)$")


def normalize_url(url: Column) -> Column:
    """No scheme, www., fragment, default port, last slash or utm_ parameters; other parameters sorted."""
    name = F.regexp_replace(host(url), r"^www\.", "")
    port = F.regexp_extract(_host_port(url), r":([0-9]+)$", 1)
    kept = F.when((port == "") | ((scheme(url) == "http") & (port == "80")) | ((scheme(url) == "https") & (port == "443")), F.lit("")).otherwise(F.concat(F.lit(":"), port))
    path = F.regexp_replace(F.regexp_extract(_rest(url), r"^//[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    parameters = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit("utm_"))))
    return F.concat(name, kept, path, F.when(F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&"))).otherwise(F.lit("")))


def doc_id(url: Column) -> Column:
    return F.sha2(normalize_url(url), 256)


def story_id(link: Column) -> Column:
    """The name-based UUID (version 3) of a link in the namespace of URLs, as hex digits."""
    h = F.md5(F.concat(F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8")), F.encode(link, "UTF-8")))
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble.bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat(F.substring(h, 1, 12), F.lit("3"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))


def date_from_name(name: Column, on_basename: bool = False) -> Column:
    """YYYY-MM-DD from the front of a name, null without one."""
    of = F.substring_index(name, "/", -1) if on_basename else name
    pattern = r"^(\d{4})[_-](\d\d)[_-](\d\d)"
    parts = [F.regexp_extract(of, pattern, i) for i in (1, 2, 3)]
    return F.when(parts[0] != "", F.concat_ws("-", *parts))


def file_key(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?i)\.(gz|gzip)$", "")


def split_object_url(url: Column) -> Column:
    """(scheme, bucket, key) of scheme://bucket/key; null for other text."""
    pattern = r"^([^:]+)://([^/]*)/?(.*)$"
    parts = [F.regexp_extract(url, pattern, i) for i in (1, 2, 3)]
    return F.when(url.rlike(pattern), F.struct(parts[0].alias("scheme"), parts[1].alias("bucket"), parts[2].alias("key")))
