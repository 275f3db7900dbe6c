from decimal import Decimal

from starflow.plans import ingest
from starflow.schemas import COMPANIES_DAILY
from starflow.sources.page_rules import DAILY_RULES

QUOTE = """<html><body>
<fin-streamer data-field="regularMarketPreviousClose" data-value="{prev}">x</fin-streamer>
<fin-streamer data-field="regularMarketOpen">{open}</fin-streamer>
<span class="label yf-1jj98ts">Bid</span><span class="value yf-1jj98ts">223.80 x 100</span>
<span class="label yf-1jj98ts">Market Cap (intraday)</span><span class="value yf-1jj98ts">3.35T</span>
<span class="label yf-1jj98ts">Earnings Date</span><span class="value yf-1jj98ts">Apr 30, 2025, "late"</span>
</body></html>"""


def test_ingest_pages_end_to_end(spark, tmp_path):
    pages = spark.createDataFrame(
        [("AAPL", QUOTE.format(prev="222.13", open="221.32")),
         ("MSFT", QUOTE.format(prev="400.005", open="1,234.5")),  # open fails numeric cast
         ("BAD", "")],
        "symbol string, html string")
    root, ingress, ods = (str(tmp_path / x) for x in ("snap", "ingress", "ods"))
    good_pages = pages.filter("symbol != 'MSFT'")
    _, rejects = ingest.ingest_pages(spark, good_pages, DAILY_RULES, COMPANIES_DAILY, root, "daily",
                                     "2025-04-01 19:00:00", ingress, ods,
                                     symbol=good_pages["symbol"])
    assert [r.symbol for r in rejects.collect()] == ["BAD"]
    out = ingest.read_ods(spark, ods, COMPANIES_DAILY).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.symbol, r.previous_close, r.open_price) == ("AAPL", Decimal("222.13"), Decimal("221.32"))
    assert r.earnings_date == 'Apr 30, 2025, "late"' and r.bid == "223.80 x 100"
    assert str(r.load_timestamp_utc) == "2025-04-01 00:00:00"
    # same day again with a new price: updated in place, not duplicated
    again = spark.createDataFrame([("AAPL", QUOTE.format(prev="230.00", open="1"))],
                                  "symbol string, html string")
    ingest.ingest_pages(spark, again, DAILY_RULES, COMPANIES_DAILY, root, "daily",
                        "2025-04-01 21:00:00", ingress, ods, symbol=again["symbol"])
    out = ingest.read_ods(spark, ods, COMPANIES_DAILY).collect()
    assert len(out) == 1 and out[0].previous_close == Decimal("230.00")
    # a backfill restricted to one symbol on another day adds only that symbol
    both = spark.createDataFrame([("AAPL", QUOTE.format(prev="1", open="1")),
                                  ("MSFT", QUOTE.format(prev="2", open="2"))],
                                 "symbol string, html string")
    ingest.ingest_pages(spark, both, DAILY_RULES, COMPANIES_DAILY, root, "daily",
                        "2025-04-02 19:00:00", ingress, ods, symbol=both["symbol"], symbols="MSFT")
    got = sorted((r.symbol, str(r.load_timestamp_utc)) for r in
                 ingest.read_ods(spark, ods, COMPANIES_DAILY).collect())
    assert got == [("AAPL", "2025-04-01 00:00:00"), ("MSFT", "2025-04-02 00:00:00")]
