"""Parsers against published strings."""

import html

from pyspark.sql import functions as F

from evenkeel.functions import forms, identifiers, letters, money, text


def parse(spark, *names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = {r["name"]: r.asDict() for r in
             identifiers.with_parsed_identifier(df, "name").collect()}
    return [found[n] for n in names]


# Published names and the parts they hold.
PARTS = ("state_code", "payment_type", "payment_type_normalised", "provider_class",
         "review_type_normalised", "rating_period_start", "rating_period_end",
         "identifier_suffix", "identifier_parsed")
CASES = [
    ("MO_Fee_BHO_Renewal_20250701-20260630",
     ("MO", "Fee", "FEE", "BHO", "Renewal", "2025-07-01", "2026-06-30", None, True), []),
    ("CA_VBP_IPH.OPH_Renewal_20240101-20241231",
     ("CA", "VBP", "VBP", "IPH.OPH", "Renewal", "2024-01-01", "2024-12-31", None, True), []),
    ("NJ_Fee_IPH.OPH_Renewal_20250701-20260630 Atlantic",
     ("NJ", "Fee", "FEE", "IPH.OPH", "Renewal", "2025-07-01", "2026-06-30", "Atlantic", True), []),
    ("CA-Fee-D-Renewal-20230101-20231231",
     ("CA", "Fee", "FEE", "D", "Renewal", "2023-01-01", "2023-12-31", None, True),
     ["fields were hyphen separated"]),
    ("UT_Fee_IPH1_Amend_07012022-06302023",
     ("UT", "Fee", "FEE", "IPH1", "Amendment", "2022-07-01", "2023-06-30", None, True),
     ["date read as MMDDYYYY"]),
    ("HI-VBP-Fee-IPH-OPH-Renewal-20230101-20231231",
     ("HI", "VBP.Fee", "FEE.VBP", "IPH_OPH", "Renewal", "2023-01-01", "2023-12-31", None, True),
     ["fields were hyphen separated", "combined payment type was split across two tokens"]),
    ("FL_Fee.IPH.OPH5_Renewal_20241001-20250131",
     ("FL", "Fee", "FEE.IPH.OPH5", "IPH.OPH5", "Renewal", "2024-10-01", "2025-01-31", None, True),
     ["payment type and provider class were one token"]),
    ("\\GA_Fee_IPH.OPH2_Amend_20230701-20240630",
     ("GA", "Fee", "FEE", "IPH.OPH2", "Amendment", "2023-07-01", "2024-06-30", None, True),
     ["leading stray character removed from the identifier"]),
    ("Fl-Fee-Pc-Sp-Renewal-20221001-20230930",
     ("FL", "Fee", "FEE", "Pc_Sp", "Renewal", "2022-10-01", "2023-09-30", None, True),
     ["state code was not upper case", "fields were hyphen separated"]),
    ("AZ_Fee_AMC_Amend_ 20211001-20220930",
     ("AZ", "Fee", "FEE", "AMC", "Amendment", "2021-10-01", "2022-09-30", None, True), []),
    ("FL_Fee_IPH.OPH3_Renewal_202221001-20230930",
     ("FL", "Fee", "FEE", "IPH.OPH3", "Renewal", None, "2023-09-30", None, False),
     ["date has 9 digits, expected 8"]),
    ("NM_VBP.Fee_NF2_Renewal_20260101-2026123",
     ("NM", "VBP.Fee", "FEE.VBP", "NF2", "Renewal", "2026-01-01", None, None, False),
     ["date has 7 digits, expected 8"]),
    ("NM_Proposal B 2021_Amendment",
     (None, None, None, None, None, None, None, None, False), []),
    ("WI_Fee_HCBS9_20250101-20251231",
     ("WI", "Fee", "FEE", "HCBS9", None, "2025-01-01", "2025-12-31", None, True),
     ["no review type in the identifier"]),
    ("Fl-Proposal-D-Amendment-2020-2021",
     ("FL", "Proposal", "PROPOSAL", "D", "Amendment", "2020-01-01", "2021-12-31", None, True),
     ["rating period given as years only; assumed full calendar years",
      "state code was not upper case", "fields were hyphen separated"]),
    ("XX_FEE.vbp_IPH_Amend3_20250101-20251231",
     ("XX", "FEE.vbp", "FEE.VBP", "IPH", "Amendment", "2025-01-01", "2025-12-31", None, True), []),
]


def test_identifiers(spark):
    rows = parse(spark, *[c[0] for c in CASES])
    for (name, parts, repairs), row in zip(CASES, rows):
        assert tuple(row[p] for p in PARTS) == parts, name
        assert row["identifier_repairs"] == repairs, name
        assert row["identifier_parsed"] == (row["identifier_issue"] is None), name
    issues = {c[0]: r["identifier_issue"] for c, r in zip(CASES, rows)}
    assert issues["NM_Proposal B 2021_Amendment"] == "no rating period found in the identifier"
    assert "9 digits" in issues["FL_Fee_IPH.OPH3_Renewal_202221001-20230930"]


def test_version_rank(spark):
    words = ["New", "Renewal", "Amend", "Amend1", "Amend2", " amendment3 ", "Amend0", "Other", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    ranks = [r["r"] for r in df.select(
        "i", identifiers.version_rank(F.col("w")).alias("r")).orderBy("i").collect()]
    assert ranks == [0, 1, 2, 2, 3, 4, 1, None, None]


AGREE = [
    ("Nv-Fee-Amc-Renewal-20230101-20231231", "NV_Fee_AMC_Renewal_20230101-20231231"),
    ("FL_Fee_IPH.OPH3_Renewal_20221001-20230930", "FL_Fee_IPH.OPH3_ Renewal_20221001-20230930"),
    ("AZ_Fee_IPH.OPH1_Renewal_20231001-20240930", "AZ_Fee_IP.OP1_Renewal_20231001-20240930"),
    ("NM_VBP_NF2_Renewal_20230101-20231231",
     "Healthcare Quality Surcharge (NM_VBP_NF2_Renewal_20230101-20231231)"),
    ("AZ_Fee_AMC_Renewal_20221001-20230930",
     "AZ_Fee_AMC_Amend_20221001-20230930 /AZ_Fee_AMC_Renewal_20221001-20230930"),
    ("MO_Fee_BHO_Renewal_20250701-20260630", None),
    ("MO_Fee_BHO_Renewal_20250701-20260630", " "),
]
DIFFER = [
    ("AZ_Fee_IPH.OPH1_Renewal_20231001-20240930", "AZ_Fee_IP.OP2_Renewal_20231001-20240930",
     "document disagrees on provider_class: filename 'AZ_Fee_IPH.OPH1_Renewal_20231001-20240930', "
     "document 'AZ_Fee_IP.OP2_Renewal_20231001-20240930'"),
    ("HI_VBP.Fee_NF_Renewal_20240101-20241231", "C", "CMS ID field holds no identifier: 'C'"),
    ("HI_VBP.Fee_NF_Renewal_20240101-20241231", "it's",
     'CMS ID field holds no identifier: "it\'s"'),
    ("VA_Fee_Oth_Renewal_20240701-20250630",
     "VA_Fee_Oth_New_20200701-20210630; VA_Fee_Oth_Renewal_20220701-20230630",
     "document disagrees on rating_period_start, rating_period_end: filename "
     "'VA_Fee_Oth_Renewal_20240701-20250630', document "
     "'VA_Fee_Oth_New_20200701-20210630; VA_Fee_Oth_Renew'"),
]


def test_cross_check(spark):
    pairs = [(*p, None) for p in AGREE] + DIFFER
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)],
                               "i int, a string, b string")
    checked = identifiers.with_cross_check(df, "a", "b", "m").orderBy("i").collect()
    found = [r["m"] for r in checked]
    assert found == [p[2] for p in pairs]


# Answers and (cents, ambiguous, implausible, issue contains).
AMOUNTS = [
    ("$310.4 million", 31_040_000_000, False, False, None),
    ("$310.4 Million", 31_040_000_000, False, False, None),
    ("$310.4M", 31_040_000_000, False, False, None),
    ("$310.4 M", 31_040_000_000, False, False, None),
    ("$388,500,819", 38_850_081_900, False, False, None),
    ("$95,851,058 (including the impact of the increase)", 9_585_105_800, False, False, None),
    ("Approximately $3,093.1 million", 309_310_000_000, False, False, None),
    ("$59.12M including the impact of prior year", 5_912_000_000, False, False, None),
    ("$1.2 billion", 120_000_000_000, False, False, None),
    ("396.97", 39_697, True, False, "unit assumed"),
    ("$396.97", 39_697, False, False, None),
    ("396.97 million", 39_697_000_000, False, False, None),
    ("$9,085,139 million", 908_513_900_000_000, False, True, "$9,085,139,000,000 exceeds"),
    ("$9,148,763,142", 914_876_314_200, False, False, None),
    ("1.2345 thousand", None, False, False, "more decimal places"),
    ("5 Medicaid plans", 500, True, False, "unit assumed"),
    ("5.999", 599, True, False, "unit assumed"),
    ("see attachment", None, False, False, "no number"),
    ("", None, False, False, "field is empty"),
    ("   ", None, False, False, "field is empty"),
    (None, None, False, False, "field is empty"),
]


def test_form_amounts(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(AMOUNTS)], "i int, a string")
    rows = df.select("i", money.read_amount(F.col("a")).alias("r")).orderBy("i").collect()
    for (answer, cents, ambiguous, implausible, issue), row in zip(AMOUNTS, rows):
        got = row["r"]
        assert (got["cents"], got["ambiguous_unit"], got["implausible"]) == (
            cents, ambiguous, implausible), answer
        assert (issue in got["issue"]) if issue else got["issue"] is None, answer


LETTERS = [
    ("through a separate payment term of up to $5,102,154.", "separate_payment_term", 510_215_400),
    ("through a separate payment term up to $385.1 million.", "separate_payment_term",
     38_510_000_000),
    ("a separate payment term amount up to $12,345,678.", "separate_payment_term", 1_234_567_800),
    ("through a risk-based rate adjustment of up to $150,850,000.", "risk_based_adjustment",
     15_085_000_000),
    ("with a total dollar amount of $54,542,328", "total_dollar_amount", 5_454_232_800),
    ("SEPARATE\n  PAYMENT\tTERM of $1.5 Billion", "separate_payment_term", 150_000_000_000),
    ("Delaware DSHP Plus (MCO managed care) $4,000,000 $6,000,000", None, None),
    ("incorporated through a risk based rate adjustment. This letter", None, None),
    ("is approved: a risk-based rate adjustment of up to $150,850,000. The state submitted the "
     "total dollar amount of $165,400,000.", "risk_based_adjustment", 15_085_000_000),
    ("SECTION I: the amount, not to exceed $4 per claim", None, None),
    ("phase-down: not to exceed $0", "not_to_exceed", 0),
]


def test_letters(spark):
    df = spark.createDataFrame(
        [(i, [t]) for i, (t, _, _) in enumerate(LETTERS)], "i int, pages array<string>")
    rows = letters.with_letter_amount(df, "pages", letters.PUBLISHED).orderBy("i").collect()
    for (text_, phrase, cents), row in zip(LETTERS, rows):
        assert (row["matched_phrase"], row["amount_cents"]) == (phrase, cents), text_
    assert rows[6]["all_amounts_cents"] == [400_000_000, 600_000_000]
    assert rows[6]["issue"] == "2 amount(s) in the letter, none under a recognised phrase"
    assert rows[7]["issue"] == letters.NO_AMOUNT
    assert rows[8]["issue"] == "letter states a different amount elsewhere ($165,400,000)"
    assert (rows[9]["letter_type"], rows[9]["issue"]) == (
        letters.FORM_ONLY, "document is the preprint form with no approval letter")
    assert rows[10]["letter_type"] == letters.PHASE_DOWN_TYPE
    assert rows[10]["issue"].startswith("figure is a grandfathering cap")


def test_letter_reads_three_pages(spark):
    pages = ["is approved", "page", "total amount of", "$5", "not to exceed $7"]
    df = spark.createDataFrame([(pages,)], "pages array<string>")
    row = letters.with_letter_amount(df, "pages", letters.PUBLISHED).first()
    assert (row["letter_pages_read"], row["amount_cents"]) == (3, None)


def test_forms(spark):
    many = {f"f{i}": "x" for i in range(40)}
    prose = dict(many, **{"Total Amounts Transferred by This Entity i and the date": "x"})
    maps = [
        {"4-Text": "$5 million", "0.2-CMS ID": " C ", "4.a-Text": ""},
        {f"f{i}": "x" for i in range(6)}, prose, many, None]
    df = spark.createDataFrame(list(enumerate(maps)), "i int, f map<string,string>")
    rows = [r["r"] for r in df.select(
        "i", forms.read_form(F.col("f"), F.lit("bad file")).alias("r")).orderBy("i").collect()]
    assert [r["template"] for r in rows] == ["numbered", "minimal", "prose", "unknown", "unknown"]
    assert (rows[0]["cms_id"], rows[0]["total"]["cents"]) == ("C", 500_000_000)
    assert rows[0]["federal_share"]["issue"] == "field is empty"
    assert rows[1]["total"]["issue"] == "not read"
    assert rows[2]["issue"] == "prose template is not yet mapped to logical fields"
    assert (rows[4]["field_count"], rows[4]["issue"]) == (0, "unreadable PDF: bad file")


def test_text_lines(spark):
    df = spark.createDataFrame(
        [("<p>A &amp; B</p> <br> it&#39;s &#x41;&amp;lt; &copy; <b></b>",)], "h string")
    lines = df.select(text.text_lines(F.col("h")).alias("l")).first()["l"]
    assert lines == ["A & B", "it's A&lt; ©"]


def test_unescape_as_html_does(spark):
    samples = ["&eacute;&hellip;x", "&ampx &lt", "&amp;amp; && &unknown; &", "a&#8364;b&#x20AC;",
               "&NotEqualTilde; &frac12;", "plain", "&#65 &copy2026"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = [r["u"] for r in df.select("i", text.unescape(F.col("s")).alias("u")).orderBy("i").collect()]
    assert got == [html.unescape(s) for s in samples]


def test_character_references_like_a_browser(spark):

    from evenkeel.plans.document_queries import REFERENCES
    given = [*REFERENCES, "&#65;&#x42;c", "a&b&lt", "&gt;=", *[f"&#{n};" for n in range(120, 165)],
             *[f"&#x{n:x}x" for n in (0x1F, 0x20, 0xFFFE, 0x1FFFF, 0x10FFFF, 0xD7FF, 0xE000, 0x1F600)]]
    df = spark.createDataFrame(list(enumerate(given)), "i int, t string")
    got = [r["u"] for r in df.select("i", text.unescape(F.col("t")).alias("u")).orderBy("i").collect()]
    assert got == [html.unescape(t) for t in given]


def test_a_letter_is_read_whole_unless_told_otherwise(spark):
    df = spark.createDataFrame([(["is approved."] * 5 + ["total amount of $7"],)], "pages array<string>")
    whole = letters.with_letter_amount(df, "pages").first()
    some = letters.with_letter_amount(df, "pages", letters.PUBLISHED).first()
    assert (whole["amount_cents"], whole["letter_pages_read"]) == (700, 6)
    assert (some["amount_cents"], some["letter_pages_read"]) == (None, 3)
