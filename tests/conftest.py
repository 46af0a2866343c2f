import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("trawl-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def page(title, body, head=""):
    return f"<html><head><title>{title}</title>{head}</head><body>{body}</body></html>"


def link(href):
    return f'<a href="{href}"></a>'


# Four pages whose index and scores were worked out by hand.
PAGES = [
    (
        "http://h.test/a",
        page(
            "Tart pie",
            "tart tart <script>tart</script> the pie shop"
            + link("/b") + link("/b") + link("/a") + link("c.html"),
        ),
    ),
    ("http://h.test/b", page("Apples", "apple of pie" + link("/a"))),
    ("http://h.test/c.html", page("Shop", "the pie")),
    ("http://h.test/d", page("Rain", "rain rain")),
]


@pytest.fixture(scope="session")
def pages(spark):
    return spark.createDataFrame(PAGES, "url string, html string").cache()


@pytest.fixture(scope="session")
def analysed(pages):
    from trawl import analyse, html_pages, page_fields

    return analyse(page_fields(html_pages(pages))).cache()


@pytest.fixture(scope="session", params=["views", "store"])
def index(request, spark, analysed):
    """The same index as views over analysed rows and read from a store."""
    from trawl import IndexStore, index_of
    from trawl.session import new_folder

    if request.param == "views":
        return index_of(analysed)
    store = IndexStore(spark, new_folder(spark, "golden"), buckets=4)
    store.append(analysed, 0)
    return store.load()
