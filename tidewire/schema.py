"""Field lists of the story's parts and of the output tables."""

RSS_ENTRY = "link string, title string, domain string, pub_date string, fetch_date string, source_url string, source_feed_id bigint, source_source_id bigint, via string"
RAW_HTML = "html binary, encoding string"
HTTP_METADATA = "response_code int, fetch_timestamp double, final_url string, encoding string"
CONTENT_METADATA = (
    "original_url string, url string, normalized_url string, canonical_domain string, publication_date string, language string, full_language string, "
    "text_extraction_method string, article_title string, normalized_article_title string, text_content string, parsed_date string, canonical_url string, "
    "is_homepage boolean, is_shortened boolean"
)
PARTS = {"rss_entry": RSS_ENTRY, "http_metadata": HTTP_METADATA, "content_metadata": CONTENT_METADATA}
STORY = ", ".join(f"{k} struct<{v}>" for k, v in {**PARTS, "raw_html": RAW_HTML}.items())
INDEX = "doc_id string, article_title string, text_content string, canonical_domain string, language string, indexed_date timestamp, publication_date string, url string"
CRUMB = "date string, feed_id bigint, source_id bigint, domain string, app string, status string, count bigint"
