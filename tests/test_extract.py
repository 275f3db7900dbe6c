import pytest

from starflow.sources import pages as P
from starflow.sources.page_rules import DAILY_RULES, WEEKLY_RULES

QUOTE = """<html><body>
<fin-streamer data-field="regularMarketPreviousClose" data-value=" 222.13 ">x</fin-streamer>
<fin-streamer data-field="regularMarketOpen">  221.32 </fin-streamer>
<ul><li><span class="label yf-1jj98ts">Bid</span><span class="value yf-1jj98ts"> 223.80 x 100 </span></li>
<li><span class="label yf-1jj98ts">Ask</span></li>
<li><span class="label yf-1jj98ts">Volume</span><!-- c --><span class="value yf-1jj98ts">1,000</span></li>
</ul></body></html>"""

PROFILE = """<html><body><h1 class="yf-xxbei9 big">Apple Inc.</h1>
<div class="address yf-wxp4ja"><div>One Apple Park Way</div><div>Cupertino, CA 95014</div></div>
<dl><dt class="yf-wxp4ja">Sector:</dt><dd>Technology</dd>
<dt class="yf-wxp4ja">Industry:</dt><a class="subtle-link fin-size-large yf-17w8w6">Consumer Electronics</a>
<dt class="yf-wxp4ja">Full Time Employees:</dt><dd><strong>164,000</strong></dd></dl>
<section data-testid="description"><h3>Description</h3><p>Apple &amp; co.</p><script>var x = 1;</script></section>
"""  # cut off: no closing tags


def field(html, rules, name):
    vals, err = P.extract_fields(html, rules)
    assert err is None
    return dict(zip([r.field for r in rules], vals))[name]


def test_attr_rule_data_value_and_text():
    assert field(QUOTE, DAILY_RULES, "previous_close") == "222.13"
    assert field(QUOTE, DAILY_RULES, "open_price") == "221.32"


def test_label_rule_sibling():
    assert field(QUOTE, DAILY_RULES, "bid") == "223.80 x 100"
    assert field(QUOTE, DAILY_RULES, "volume") == "1,000"
    assert field(QUOTE, DAILY_RULES, "ask") is None           # sibling absent
    assert field(QUOTE, DAILY_RULES, "beta") is None          # label absent


def test_profile_page_cut_off():
    assert field(PROFILE, WEEKLY_RULES, "company_name") == "Apple Inc."   # class word match
    assert field(PROFILE, WEEKLY_RULES, "company_address") == "One Apple Park WayCupertino, CA 95014"
    assert field(PROFILE, WEEKLY_RULES, "company_sector") == "Technology"
    assert field(PROFILE, WEEKLY_RULES, "company_industry") == "Consumer Electronics"
    assert field(PROFILE, WEEKLY_RULES, "company_full_time_employees") == "164,000"
    assert field(PROFILE, WEEKLY_RULES, "company_description") == "DescriptionApple & co."
    assert field(PROFILE, WEEKLY_RULES, "company_phone_number") is None


def test_label_not_nested_returns_label():
    r = P.LabelRule("x", "span", "label", "Bid")
    assert P.extract_fields('<span class="label">  Bid </span>', [r])[0] == ["Bid"]
    # an element with more than one child has no single string: no match
    assert P.extract_fields('<span class="label">Bid<b>!</b></span>', [r])[0] == [None]


def test_unknown_rule_kind():
    with pytest.raises(ValueError):
        P.rule_from_config({"target_field": "x", "html_element_tag": "div"})
    r = P.rule_from_config({"target_field": "x", "html_element_tag": "div",
                            "identifier_attribute": "id", "identifier_value": "a",
                            "is_data_value": True})
    assert isinstance(r, P.AttrRule)


def test_empty_page_is_rejected(spark):
    df = spark.createDataFrame([(1, QUOTE), (2, ""), (3, None)], "page_id long, html string")
    good, bad = P.split_rejects(P.extract_records(df, P.rules_for("daily")))
    assert [r.page_id for r in good.collect()] == [1]
    assert sorted(r.page_id for r in bad.collect()) == [2, 3]
    assert good.columns == ["page_id"] + [r.field for r in DAILY_RULES]


def test_scope_rules():
    assert len(P.rules_for("daily")) == 15 and len(P.rules_for("weekly")) == 9
    with pytest.raises(ValueError):
        P.rules_for("hourly")


def test_load_timestamp_column(spark):
    df = spark.createDataFrame([(1, QUOTE)], "page_id long, html string")
    out = P.extract_records(df, DAILY_RULES[:1], load_ts="2025-04-01 19:00:05").first()
    assert str(out.load_timestamp_utc) == "2025-04-01 00:00:00"


def test_deeply_nested_page():
    deep = '<div class="ad">' + "<b>" * 5000 + "deep text" + "</b>" * 5000 + "</div>"
    r = P.AttrRule("ad", "div", "class", "ad")
    vals, err = P.extract_fields(deep, [r])
    assert err is None and vals == ["deep text"]
    lab = P.LabelRule("x", "b", None, "deep text")
    assert P.extract_fields(deep, [lab])[0] == ["deep text"]
