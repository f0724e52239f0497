from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobtide.functions import classify, dates, normalize, salary, text
from jobtide.functions.stem import stem


def test_titles(values):
    rows = ["Sr. SWE", "junior dev", "SENIOR ENGINEER", "ml eng", "Staff SRE", "vp of engineering", "devops iii"]
    assert values([(r,) for r in rows], "t string", normalize.normalize_title("t")) == [
        "Senior Software Engineer", "Junior Developer", "Senior Engineer", "Machine Learning Engineer",
        "Staff Site Reliability Engineer", "Vice President Of Engineering", "Devops III"]


def test_companies(values):
    rows = ["Acme, Inc.", "Google LLC", "Microsoft Corporation", "Apple Inc", "Meta Platforms, Inc.", "Foo Co., LLC", None]
    assert values([(r,) for r in rows], "c string", normalize.normalize_company("c")) == [
        "Acme", "Google", "Microsoft", "Apple", "Meta Platforms", "Foo", ""]


@pytest.mark.parametrize("raw, label", [
    ("SF, CA", "San Francisco, CA"), ("New York, NY", "New York, NY"), ("Remote - US", "Remote"),
    ("San Francisco, California, USA", "San Francisco, CA"), ("London, UK", "London, UK"), ("Remote", "Remote"),
    ("Austin, TX, United States", "Austin, TX"), ("WFH - Austin/TX", "Remote (Austin, TX)"),
    ("Texas, Canada", "Canada, TX"), ("o'fallon, missouri", "O'Fallon, MO"),
])
def test_locations(values, raw, label):
    assert values([(raw,)], "l string", normalize.location_label(normalize.parse_location("l"))) == [label]


def test_location_parts(values):
    place = normalize.parse_location("l")
    assert values([("LA",), ("ca",), ("Toronto, CANADA",)], "l string", place["city"], place["state_code"], place["country"]) == [
        ("Los Angeles", None, None), (None, "CA", "United States"), ("Toronto", None, "Canada")]


def test_annual_salary(values):
    rows = [(50, 75, "hourly", "USD"), (100000, 150000, "yearly", "USD"), (80000, 100000, "yearly", "EUR"),
            (5000, 7000, "monthly", "USD"), (None, 0, "three", "xx"), (9, 5, None, None)]
    s = salary.annualize_salary("a", "b", "p", "c")
    assert values(rows, "a int, b int, p string, c string", s["min_yearly"], s["max_yearly"], s["is_estimated"]) == [
        (104000, 156000, True), (100000, 150000, False), (88000, 110000, False), (60000, 84000, True),
        (None, None, True), (0, 0, True)]


def test_salary_in_text(values):
    rows = [("Salary: $120,000 - $180,000 per year",), ("Compensation: $50-75 per hour",),
            ("Pay range: $80k - $120k annually",), ("100,000 - 150,000 USD",), ("no pay",), ("$80.5k to $90k",)]
    s, plain = salary.extract_salary("t"), salary.extract_salary("t", honor_k=False)
    assert values(rows, "t string", s["min_yearly"], s["max_yearly"], plain["min_yearly"]) == [
        (120000, 180000, 120000), (104000, 156000, 104000), (80000, 120000, 0), (100000, 150000, 100000),
        (None, None, None), (80000, 90000, 80000)]


@pytest.mark.parametrize("raw, expected", [
    ("£100k-£150k", (100000, 150000)), ("€85.5k to €95.5k", (85500, 95500)), ("¥1000k", (1000000, 1000000)),
    ("₹500k-₹750k", (500000, 750000)), ("125.5k", (125500, 125500)), ("150.75K", (150750, 150750)),
    ("99.9k-100.1k", (99900, 100100)), ("85.25k to 95.75k", (85250, 95750)),
    ("Salary range: $100,000 - $150,000 per annum", (100000, 150000)),
    ("Compensation: £80k-£120k depending on experience", (80000, 120000)), ("To be determined", (None, None)),
    ("Competitive package", (None, None)), ("Contact for details", (None, None)), ("100-120k", (100000, 120000)),
    ("100k-120", (100000, 120000)), ("110k to 150k", (110000, 150000)), ("up to $150k", (None, 150000)),
    ("starting at $100k", (100000, None)), ("$50 per hour", (104000, 104000)), ("   ", (None, None)),
    ("random text 100", (100, 100)),
])
def test_salary_text(values, raw, expected):
    s = salary.parse_salary_text("t")
    assert values([(raw,)], "t string", s["min_salary"], s["max_salary"]) == [expected]


def test_salary_interval(values):
    s = salary.extract_salary_interval("t")
    rows = [("$20 - $30",), ("$5,000 – 6,000",), ("$80k-$120k",), ("$90 - $50",), ("$400-$500",)]
    assert values(rows, "t string", s["interval"], s["min_amount"], s["max_amount"]) == [
        ("hourly", 20, 30), ("monthly", 5000, 6000), ("yearly", 80000, 120000), (None, None, None), ("monthly", 400, 500)]


def test_salary_labels(values):
    assert values([(125000, 2800000), (None, 900), (100, None), (None, None)], "a int, b int",
                  salary.salary_compact("a"), salary.salary_compact("b"), salary.salary_range_label("a", "b")) == [
        ("$125k", "$2.8M", "$125,000 - $2,800,000"), ("$0", "$900", "Up to $900"), ("$100", "$0", "$100+"),
        ("$0", "$0", "Not specified")]


def test_classification(values):
    rows = [
        ("Junior Software Engineer", "Great opportunity for new graduates. No experience required.", None),
        ("Software Engineer", "Looking for engineers with 5+ years of experience in Python.", None),
        ("Senior Backend Developer", "We need a senior engineer with 7-10 years of experience.", None),
        ("Staff Engineer", "Lead technical initiatives across multiple teams. 10+ years required.", None),
        ("Software Engineering Intern", "Summer 2024 internship opportunity.", None),
        ("Full Stack Developer", "Remote position. Work from anywhere. Hybrid option available.", "Remote, USA"),
        ("Plumber", None, None)]
    c = classify.classification("t", "d", "l")
    assert values(rows, "t string, d string, l string", c["experience_level"], c["job_type"], c["remote_type"],
                  c["entry_friendly"], c["years_required"], c["confidence"]) == [
        ("entry", "unknown", "unknown", True, None, 0.7), ("senior", "unknown", "unknown", False, 5, 0.7),
        ("senior", "unknown", "unknown", False, 7, 0.8), ("staff", "unknown", "unknown", False, None, 0.7),
        ("intern", "internship", "unknown", True, None, 0.8), ("unknown", "unknown", "hybrid", True, None, 0.6),
        ("unknown", "unknown", "unknown", True, None, 0.3)]


@pytest.mark.parametrize("title, description, minimum, preferred, expected", [
    ("Junior Software Engineer", "Looking for a junior developer.", "Bachelor's degree.", "Python.", True),
    ("Senior Software Engineer", "Looking for a senior developer.", "Bachelor's degree.", "Python.", False),
    ("Software Engineer", "This is an entry-level position.", "Bachelor's degree.", "Python.", True),
    ("Lead Software Engineer", "This is a lead position.", "", "", False),
    ("Software Engineer", "d", "Junior developer with 0-1 years of experience.", "", True),
    ("Software Engineer", "d", "BS with 0-3+ years of relevant experience", "", True),
    ("Software Engineer", "d", "BS with 1-3+ years of relevant experience", "", True),
    ("Software Engineer", "d", "BS and 3 + years...", "", False),
    ("Software Engineer", "d", "A minimum of 3 years of network experience", "", False),
    ("Software Engineer", "d", "2-3 years of experience software development", "", False),
    ("Software Engineer", "d", "", "2-3+ years expected with previous internship experience", False),
    ("Software Engineer", "d", "0-2 years of experience.", "", True),
    ("Software Engineer", "d", "1 year of experience.", "", True),
    ("", "", "", "", True),
])
def test_strict_entry_level(values, title, description, minimum, preferred, expected):
    assert values([(title, description, minimum, preferred)], "t string, d string, m string, p string",
                  classify.is_entry_level_strict("t", "d", "m", "p")) == [expected]


def test_urls(values):
    rows = ["https://www.Example.com/Jobs/1/?utm_source=x&id=7&ref=y#top", "http://a.b/c/", "HTTP://A.B", "", None,
            "https://x.y/?gclid=1"]
    assert values([(r,) for r in rows], "u string", text.normalize_url("u")) == [
        "https://example.com/jobs/1?id=7", "http://a.b/c", "http://a.b", "", "", "https://x.y"]


def test_hashes(values):
    rows = [("A-B", "x", None), ("a b", "X", "")]
    strict = values(rows, "t string, c string, l string", text.content_hash("t", "c", "l"))
    loose = values(rows, "t string, c string, l string", text.content_hash("t", "c", "l", "normalised"))
    assert strict[0] != strict[1] and loose[0] == loose[1] and len(strict[0]) == 64
    with pytest.raises(ValueError):
        text.content_hash("t", "c", "l", "other")


def test_text_rules(values):
    assert values([("<b>A&amp;B</b>&nbsp; c",)], "t string", text.plain_text("t")) == ["A&B c"]
    assert values([("a.b@c.io, x@y.org",)], "t string", text.joined(text.emails("t"))) == ["a.b@c.io, x@y.org"]
    assert values([("abcdefgh",)], "t string", text.truncate("t", 6), text.truncate("t", 2)) == [("abc...", "..")]
    assert values([("Éÿ Ångström",)], "t string", text.fold("t")) == ["ey angstrom"]
    assert values([("acme-inc", "Acme"), ("acme", "acne")], "a string, b string", text.alias_equal("a", "b")) == [True, False]


def test_dates(values):
    now = datetime(2024, 5, 31, 6)
    rows = [("7 hours ago",), ("30+d",), ("3 month ago",), ("2 year",), ("Yesterday",), ("Just posted",)]
    assert values(rows, "t string", dates.relative_date("t", F.lit(now))) == [
        date(2024, 5, 30), date(2024, 5, 1), date(2024, 2, 29), date(2022, 5, 31), date(2024, 5, 30), date(2024, 5, 31)]
    forms = [("2024-12-31",), ("12/31/2024",), ("31/12/2024",), ("December 31, 2024",), ("31 December 2024",), ("x",)]
    assert values(forms, "t string", dates.parse_date("t")) == [datetime(2024, 12, 31)] * 5 + [None]
    assert values([(10, 3, 60), (4, 4, 1), (4, 0, 9), (0, 0, 0), (100, 1, 100)], "a int, b int, c int",
                  dates.run_eta("a", "b", "c")) == ["2m 20s", "Done", "Calculating...", "Unknown", "2h 45m"]


def test_stems():
    # Pairs published with the algorithm.
    pairs = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
             "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
             "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "rational": "ration",
             "digitizer": "digit", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
             "triplicate": "triplic", "formalize": "formal", "electrical": "electr", "goodness": "good", "revival": "reviv",
             "allowance": "allow", "adjustment": "adjust", "adoption": "adopt", "effective": "effect", "probate": "probat",
             "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "engineers": "engin"}
    assert {w: stem(w) for w in pairs} == pairs


def test_huge_amounts_and_ages_are_null(values):
    from datetime import datetime

    from jobtide.functions import dates, salary

    rows = [(10**11, "99999999999 days", datetime(2024, 5, 1))]
    got = values(rows, "a bigint, t string, n timestamp", salary.annual_usd("a", F.lit("HOURLY"), F.lit("USD")), dates.relative_date("t", "n"))
    assert got == [(None, None)]
