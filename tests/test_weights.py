"""Null and edge rules of the scoring expressions."""

from pyspark.sql import functions as F

from shiftscore.functions.flags import base_score, premium_device
from shiftscore.functions.keywords import address_match, lead_address_match
from shiftscore.functions.nulls import r_ifelse
from shiftscore.functions.weights import (frequency_weight, interest_weight, source_weight,
                                          urgency_weight, whatsapp_days)
from shiftscore import config as C


def col_values(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_r_ifelse_null_test_gives_null(spark):
    out = col_values(spark, [(None,), (True,), (False,)], "b boolean",
                     r_ifelse(F.col("b"), F.lit(1), F.lit(0)))
    assert out == [None, 1, 0]


def test_source_weight_is_case_sensitive_and_null_propagates(spark):
    rows = [("app",), ("website",), ("CC Leads",), ("app_banner",), ("Missed call",),
            ("Whatsapp",), ("WhatsApp",), ("other",), (None,)]
    out = col_values(spark, rows, "s string", source_weight(F.col("s")))
    assert out == [5, 5, 5, 5, 3, 3, 1, 1, None]


def test_urgency_weight(spark):
    rows = [(0,), (1,), (2,), (30,), (-3,), (None,)]
    assert col_values(spark, rows, "d int", urgency_weight(F.col("d"))) == [5, 3, 1, 1, 0, 0]


def test_interest_weight_tautology_and_null(spark):
    rows = [(0,), (1,), (2,), (3,), (4,), (9,), (10,), (25,), (-1,), (None,)]
    out = col_values(spark, rows, "n int", interest_weight(F.col("n")))
    assert out == [50, 50, 30, 30, 50, 50, 10, 10, 50, None]


def test_frequency_weight(spark):
    rows = [(1, 1), (1, 12), (2, 2), (3, 3), (2, 5), (4, 4), (5, 12), (2, 10)]
    out = col_values(spark, rows, "s long, m long", frequency_weight(F.col("s"), F.col("m")))
    assert out == [10, 10, 30, 30, 50, 50, 10, 10]


def test_whatsapp_days(spark):
    rows = [("NOW",), ("Within 2 Days",), ("After 2 Days",), ("",), (None,)]
    assert col_values(spark, rows, "a string", whatsapp_days(F.col("a"))) == [0, 1, 2, None, None]


def test_order_keywords_are_substrings_ignoring_case(spark):
    rows = [("Main Market", None), ("sobha city", None), ("MG Road", "Ring Road"),
            (None, None), ("Society Lane", None), (None, "x Sri Aditya y")]
    out = col_values(spark, rows, "t string, f string",
                     address_match(["t", "f"], C.ORDER_ADDRESS_KEYWORDS))
    # "Ark" inside "Market" matches; the misspelt list never matches "Society";
    # NULL with no other hit stays NULL (SQL three-valued OR).
    assert out == [True, True, False, None, None, True]


def test_lead_drop_list_has_a_tab(spark):
    rows = [("x", "Sri Aditya Homes"), ("x", "Sri\tAditya Homes"), ("Sri Aditya Homes", "x"),
            (None, None)]
    out = col_values(spark, rows, "p string, d string",
                     lead_address_match("p", "d", C.LEAD_PICKUP_KEYWORDS, C.LEAD_DROP_KEYWORDS))
    assert out == [False, True, True, False]


def test_premium_device_is_literal_in_list(spark):
    rows = [("Android", "Pixel 6"), ("Android", "Pixel%"), ("iOS", None), (None, None),
            ("Android", "SM-G991B")]
    out = col_values(spark, rows, "p string, m string", premium_device(F.col("p"), F.col("m")))
    assert out == [0, 1, 1, 0, 0]
    patterns = C.ScoringConfig(premium_models_as_patterns=True)
    out = col_values(spark, rows, "p string, m string",
                     premium_device(F.col("p"), F.col("m"), patterns))
    assert out == [1, 1, 1, 0, 1]


def test_base_score_range(spark):
    names = [c for c, _ in C.BASE_WEIGHTS]
    ones = spark.createDataFrame([tuple([1] * len(names)), tuple([None] * len(names))],
                                 ", ".join(f"{n} int" for n in names))
    assert [r[0] for r in ones.select(base_score()).collect()] == [27, 0]


def test_keyword_lists_and_app_categories_as_stated():
    """Written out once more, apart from the configuration that both engines read."""
    from shiftscore import config as C

    names = ("Prestige|Brigade|Sobha|Godrej|Mahindra|Birla|Ark|Countryside|Lodha|Runwal|Kalpataru|Dosti|Wadhwa|Piramal|Jain|Marg|"
             "Unitech|DLF|Raheja|DGR|Adarsh|Ashiana|Parsvnath|Nagpal|Fortune|Ramky|Salapuria|{}|Jayabheri|Manbhum|Rustomjee")
    spaced, tabbed = names.format("Sri Aditya").split("|"), names.format("Sri\tAditya").split("|")
    assert list(C.ORDER_ADDRESS_KEYWORDS) == ["Apartment", "Housing", "Sociecty", "Tower", "Block", *spaced]
    assert list(C.LEAD_PICKUP_KEYWORDS) == ["Housing", "Apartment", "Sociecty", "Tower", "Block", *spaced]
    assert list(C.LEAD_DROP_KEYWORDS) == ["Housing", "Apartment", "Sociecty", "Tower", "Block", *tabbed]
    assert {cat: set(apps) for cat, apps in C.APP_CATEGORIES} == {
        "competitor": {"LYNK", "Packers & Movers by NoBroker"},
        "luxury": {"CRED", "LinkedIn", "Netflix", "Quora", "Spotify"},
        "daily convenience": {"Ola", "Swiggy", "Uber", "Zomato"},
        "E-Commerce": {"Amazon", "Curefit", "Flipkart", "Jiomart", "Myntra", "Snapdeal"},
        "house_shifting": {"ADDA - The Apartment Super App", "JioGate", "MyGate", "NoBrokerHOOD"},
    }
