"""Limits and lists of the pipeline, as parameters with their usual values."""

from __future__ import annotations

from dataclasses import dataclass

#: The mark of a story whose page is to tell its URL, where a Config gives no other. Data of another system that
#: holds such rows has a mark of its own: set need_canonical_url to it.
NEED_CANONICAL_URL = "http://example.invalid/need_canonical_url"
#: Fixed values of the exchange formats.
BAD_HOSTS = ("localhost", "127.0.0.1")
SCHEMES = ("http", "https")
RETRY_CODES = (408, 429, 500, 502, 503, 504, 522, 524)
INDEX_FIELDS = ("article_title", "canonical_domain", "language", "publication_date", "text_content", "url")
FEED_TAGS = ("rss", "feed", "rdf", "channel", "urlset", "sitemapindex")


@dataclass(frozen=True)
class Config:
    excluded_domains: tuple[str, ...] = ()
    public_suffixes: tuple[str, ...] = ()
    need_canonical_url: str = NEED_CANONICAL_URL
    max_html_bytes: int = 10_000_000
    max_field_bytes: int = 32_766
    max_redirects: int = 30
    min_text_chars: int = 100
    archive_rows: int = 5_000
    max_retries: int = 10
    retry_minutes: int = 60
    requeue_minutes: int = 2
    #: epochs of object versions: name, first day, last day
    epochs: tuple[tuple[str, str, str], ...] = (("B", "2021-09-15", "2021-11-11"), ("D", "2021-12-26", "2022-01-25"))


#: Lists that fit the synthetic tables.
FIXTURE = Config(
    excluded_domains=tuple(f"{n}.example.{t}" for n in ("casino-win", "cheap-pills", "free-bets") for t in ("com", "net", "org")),
    public_suffixes=("example.com", "example.net", "example.org"),
)
