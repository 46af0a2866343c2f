"""A text index of web pages and ranked search over it, as Spark jobs."""

from trawl.plans.index import Index, analyse, index_of, page_fields, plain_fields
from trawl.plans.report import index_report
from trawl.plans.search import parse_queries, search, search_json
from trawl.sources.pages import html_pages, latest_pages
from trawl.sources.stopwords import default_stopwords, read_stopwords
from trawl.sources.store import IndexStore
from trawl.streaming.ingest import index_batch, index_stream

__all__ = [
    "Index", "IndexStore", "analyse", "default_stopwords", "html_pages",
    "index_batch", "index_of", "index_report", "index_stream", "latest_pages",
    "page_fields", "parse_queries", "plain_fields", "read_stopwords", "search",
    "search_json",
]
