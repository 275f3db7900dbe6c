"""Rule sets for the quote page (daily) and the profile page (weekly).

Fixed values: element tags, attributes, classes and labels of the source
pages, and the field each one fills, in page order. Output field names follow
the ingress column order (the quote page's ``open`` lands in ``open_price``).
"""

from .pages import AttrRule, LabelRule

_Q_LABEL = "label yf-1jj98ts"
_Q_VALUE = "value yf-1jj98ts"


def _quote(field: str, label: str) -> LabelRule:
    return LabelRule(field, "span", _Q_LABEL, label, "span", _Q_VALUE, nested=True)


# Fixed values (quote page).
DAILY_RULES = (
    AttrRule("previous_close", "fin-streamer", "data-field", "regularMarketPreviousClose"),
    AttrRule("open_price", "fin-streamer", "data-field", "regularMarketOpen"),
    _quote("bid", "Bid"),
    _quote("ask", "Ask"),
    _quote("day_range", "Day's Range"),
    _quote("volume", "Volume"),
    _quote("avg_volume", "Avg. Volume"),
    _quote("intraday_market_cap", "Market Cap (intraday)"),
    _quote("beta", "Beta (5Y Monthly)"),
    _quote("pe_ratio", "PE Ratio (TTM)"),
    _quote("eps", "EPS (TTM)"),
    _quote("earnings_date", "Earnings Date"),
    _quote("forward_dividend_and_yield", "Forward Dividend & Yield"),
    _quote("ex_dividend_date", "Ex-Dividend Date"),
    _quote("one_year_target_estimate", "1y Target Est"),
)

# Fixed values (profile page).
WEEKLY_RULES = (
    AttrRule("company_name", "h1", "class", "yf-xxbei9"),
    AttrRule("company_address", "div", "class", "address yf-wxp4ja"),
    AttrRule("company_phone_number", "a", "aria-label", "phone number"),
    AttrRule("company_website", "a", "aria-label", "website link"),
    LabelRule("company_sector", "dt", "yf-wxp4ja", "Sector:", "dd", None, nested=True),
    LabelRule("company_industry", "dt", "yf-wxp4ja", "Industry:", "a",
              "subtle-link fin-size-large yf-17w8w6", nested=True),
    LabelRule("company_full_time_employees", "dt", "yf-wxp4ja", "Full Time Employees:", "dd",
              None, nested=True),
    AttrRule("company_description", "section", "data-testid", "description"),
    AttrRule("company_corporate_governance_score", "section", "data-testid",
             "corporate-governance"),
)
