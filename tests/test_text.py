import datetime as dt

from pyspark.sql import functions as F

from postloom.functions import dates, enrich, nulls, places, predicates, regex, text
from postloom.functions.regex import strip

NBSP = " "


def test_null_words(evaluate):
    values = ["NaN", " none ", "NaT", '"NaN"', "nano", "", None, "Nan Corp"]
    assert evaluate(values, nulls.null_words_to_null) == [
        None, None, None, None, "nano", "", None, "Nan Corp"]


def test_strip_removes_all_unicode_space(evaluate):
    assert evaluate([f"{NBSP}\t a b \n", "　"], strip) == ["a b", ""]


def test_company(evaluate):
    values = ["Client of ACME", "client OF  ACME ", " ", None, "Clients of X"]
    assert evaluate(values, text.clean_company_name) == ["ACME", "ACME", None, None, "Clients of X"]


def test_title_cleaning(evaluate):
    values = [
        "Engineer - Riyadh", "Jeddah, Saudi Arabia - Engineer", "Engineer (Remote)",
        "Engineer posted 3 days ago", "مهندس - الرياض", "مهندس منذ 3 أيام",
        "Engineer (Part Time in Riyadh)", "Engineer, KSA, Riyadh", "Riyadh", "(Remote)", None]
    assert evaluate(values, text.clean_title) == [
        "Engineer"] * 4 + ["مهندس", "مهندس", "Engineer", "Engineer", "Riyadh", "(Remote)", None]


def test_very_long_texts_do_not_break_the_matcher(evaluate):
    assert evaluate(["Engineer" + ", Riyadh" * 900, "a" + " " * 5000], text.clean_title) == [
        "Engineer", "a"]
    tag = "<a " + 'x="1" ' * 5000 + ">text</a>"
    assert evaluate([tag], text.html_to_text) == ["text"]


def test_description_cleaning(evaluate):
    values = [
        "Job Summary: About the Role - text", "About the Role: Job Summary: text", "a<br>b",
        "C# dev", "View email address on x.com end", f"a{NBSP}•\n b", "📍 وصف الوظيفة: نص",
        "x &amp; y&nbsp;z &quot;q&apos;", None, " \n "]
    assert evaluate(values, text.clean_description) == [
        "text", "Job Summary: text", "ab", "C dev", "end", "a b", "نص", "x & y z \"q'", "", ""]


def test_description_without_leading_title(evaluate):
    clean = lambda c: text.clean_description(c, F.lit("Data (Lead)"))
    assert evaluate(["Job Title: Data (Lead) build things", "build"], clean) == [
        "build things", "build"]


def test_description_is_idempotent(evaluate):
    once = evaluate(["* a <b>b</b>\t c", "Job Purpose: x — y", "#one#two"], text.clean_description)
    assert evaluate(once, text.clean_description) == once


def test_html(evaluate):
    values = [
        "an <b>X </b>Y&nbsp;&amp; z<script>s</script>", "&#65;&#x42;&#150;&#xD800;|&bogus; &copy",
        "<a title=\"x>y\" href='q'>t</a><!-- <i>no</i> -->u", "1 < 2 & 3 > 2", "plain", "", None,
        "<style>p{}</style><template>t</template><SCRIPT>x</SCRIPT >ok", "cut <a hre"]
    assert evaluate(values, text.html_to_text) == [
        f"an X Y{NBSP}& z", "AB–�|&bogus ©", "t u", "1 < 2 & 3 > 2", "plain", "", "", "ok",
        "cut <a hre"]


def test_title_from_description(evaluate):
    values = [
        "We need a Senior Data Engineer now", "a data engineer ii or data engineer",
        "pmc civil structural engineer and data engineer", "Job Title: cloud guru location riyadh",
        "job title - ops/net remote position", "nothing here", " ", None,
        "job title: one two three four five six seven"]
    assert evaluate(values, text.title_from_description) == [
        "Senior Data Engineer", "Data Engineer Ii", "Technical Professional", "Cloud Guru",
        "Ops/Net", "Technical Professional", "Technical Professional", "Technical Professional",
        "Technical Professional"]


def test_title_case(evaluate):
    assert evaluate(["ci/cd ENGINEER it's"], text.title_case) == ["Ci/Cd Engineer It'S"]


def test_title_characters(evaluate):
    assert evaluate(["★ مهندس (C++) – 1/2 ★", None], text.keep_title_characters) == [
        "مهندس (C++)  1/2", None]


def test_city(evaluate):
    values = ["الرياض", "in Jeddah", "LinkedIn Riyadh", "Saudi Arabia", None, "خميس مشيط",
              "Buraydah, Al Qassim", "AL KHOBAR"]
    assert evaluate(values, places.clean_city) == [
        "Riyadh", "Jeddah", None, None, None, "Khamis Mushait", "Al Qasim", "Al Khobar"]
    assert evaluate(["Riyadh •  Center"], places.clean_bulleted_city) == ["Riyadh"]


def test_places(evaluate):
    values = ["", None, "Austin, TX", "Huntsville, AL", "Mumbai, India", "Orange County"]
    assert evaluate(values, places.is_domestic_location) == [True, True, False, True, False, False]
    match = lambda c: places.is_country_match(c, F.lit("x"), F.lit(None))
    assert evaluate([" sa ", "US", None], match) == [True, False, False]
    by_place = lambda c: places.is_country_match(F.lit(None), c)
    assert evaluate(["Al Khobar", "Paris", None], by_place) == [True, False, False]


def test_employment_and_education(evaluate):
    kind = lambda c: enrich.employment_type(F.lit("Full-time"), c)
    assert evaluate(["part time role", "freelance", "عقد", None], kind) == [
        "Part-time", "Contract", "Contract", "Full-time"]
    assert evaluate(["Bachelor or Master", "scrum master", "Ph.D.", "ثانوي", "none", None],
                    enrich.education) == [
        "Bachelor", "Master", "PhD", "High School / Diploma", None, None]


def test_dates(evaluate):
    values = [
        "2026-08-05T07:54:34.1930000", "2026-08-05T23:54:34-08:00", "2026-8-5", "2026/08/05",
        "20260805", "08/05/2026", "Aug 5, 2026", "5 August 2026", "Wed, 05 Aug 2026 10:00:00 GMT",
        "2026-08-05Tnoon", "2026-02-30", "Not Specified", "3 days ago", "", None]
    assert evaluate(values, dates.format_date) == ["2026-08-05"] * 9 + [None] * 6


def test_more_spellings_of_dates(evaluate):
    day = ["25/12/2026", "12/25/2026", "12/25/26", "25-12-2026", "25/12/26", "dec 25 2026",
           "25-Dec-2026", "Dec. 25, 2026", "25 DECEMBER 2026", "2026-12-25 10:00:00 EST",
           "2026-12-25T10:00:00+03"]
    assert evaluate(day, dates.format_date) == ["2026-12-25"] * len(day)
    assert evaluate(["August 2026", "Sept 2026", "Decem 25 2026", "32 May 2026", "13/13/2026"],
                    dates.format_date) == ["2026-08-01", "2026-09-01", None, None, None]


def test_names_of_html_5(evaluate):
    assert evaluate(["a&check;b &plus;&comma; &nosuch; &amp;&nbsp;x"], text.html_to_text) == [
        "a✓b +, &nosuch &\xa0x"]


def test_relative_dates(evaluate):
    day = dt.date(2026, 9, 15)
    values = ["3 days ago", "3 hours ago", "منذ ٣ أيام", None, "", "today", "2026-08-05"]
    assert evaluate(values, lambda c: dates.relative_date(c, day, True)) == [
        "2026-09-12"] * 3 + ["2026-09-15"] * 3 + ["2026-08-05"]
    # without it the year counts as days
    assert evaluate(["2026-08-05"], lambda c: dates.relative_date(c, day)) == ["2021-02-27"]


def test_title_predicate(evaluate):
    values = ["Data Engineer", "Sales Manager data", "IT Support", "Chef", "", None]
    assert evaluate(values, predicates.is_tech_title) == [True, False, True, False, False, False]


def test_valid_posting(evaluate):
    good = lambda c: predicates.is_valid_posting(F.lit("Data Engineer"), c)
    assert evaluate(["a? b? c? d? e?", "a? b? c? d? e? f?", "what???", "", None], good) == [
        True, False, False, False, False]
    titled = lambda c: predicates.is_valid_posting(c, F.lit("text"))
    assert evaluate(["Solutions Architect", "Engineer", "", None], titled) == [
        False, True, False, False]


def test_tech_posting_order(evaluate):
    def judge(c):
        return predicates.is_tech_posting(F.lit("x"), c, F.filter(
            F.array(c), lambda s: s.contains("python")))

    values = ["network sales", "sales with python", "computer science", "python", "nothing",
              "information technologysysadmin doctor", None]
    assert evaluate(values, judge) == [True, False, True, True, False, False, False]


def test_url_and_length(evaluate):
    assert evaluate([" HTTPS://x", "ftp://x", "", None], predicates.is_bad_url) == [
        False, True, True, True]
    assert evaluate(["a" * 50, "a" * 49, None], predicates.is_short) == [False, True, True]


def test_foreign(evaluate):
    check = lambda c: predicates.is_foreign_posting(c, F.lit(None))
    assert evaluate(["US Citizen only", "united states", "Saudi", None], check) == [
        True, True, False, False]


def test_tags_with_very_many_quoted_values(evaluate):
    for n in (1_200, 100_000):
        tag = "<div " + " ".join(['a="x>y"'] * n) + ">"
        assert evaluate([f"<p>{tag}shown</div></p>"], text.html_to_text) == ["shown"]


def test_title_with_very_many_places(evaluate):
    title = "Engineer" + " - Riyadh, Jeddah" * 25_000
    assert evaluate([title], text.clean_title) == ["Engineer"]


def test_titles_are_no_patterns(evaluate):
    title = r"a\E(b"
    assert evaluate(
        [f"Job title: {title} needed"],
        lambda c: text.clean_description(c, F.lit(title))) == ["needed"]



def test_dates_by_grammar(evaluate):
    day = ["Wednesday, 5 August 2026", "Wed 05 Aug 2026", "August 5th, 2026", "the 5th of August, 2026",
           "10:15 2026-08-05", "10:15:30 PM Aug 5 2026", "5 Aug 2026 at 7:05 am", "2026 Aug 5", "2026, 5 August",
           "20260805T101500", "202608051015", "260805", "2026-08-05 10:00 UTC+3", "Sun, 05 Aug 2026 22:10:00 +0300",
           "2026-08-05t23:59:59.999z", "5.8.2026".replace("5.8", "8.5"), "2026/13/08".replace("13/08", "08/05"),
           "10:15 may 5 2026".replace("may", "aug"), "AUG-05-26", "7pm 5 aug 2026", "  2026-08-05\n"]
    assert evaluate(day, dates.format_date) == ["2026-08-05"] * len(day)
    assert evaluate(["10:15 may 5 2026", "2026", "08/2026", "2026-13-05", "31/31/2026", "Aug 5", "5", "05",
                     "monday", "10:15", "2026-08-05 x", "1 2 3 4", "2026-02-29", "99991231", "aug aug 2026"],
                    dates.format_date) == [
        "2026-05-05", "2026-01-01", "2026-08-01", "2026-05-13", None, None, None, None, None, None, None, None,
        None, "9999-12-31", None]


def test_lists_are_searched_by_shared_parts(evaluate):
    words = ["data engineer ii", "data engineer", "ai engineer", "soc analyst", "security analyst", "qa", "gin"]
    groups = regex.by_part(words)
    assert groups["engineer"] == ["data engineer ii", "data engineer", "ai engineer"]
    assert sorted(w for group in groups.values() for w in group) == sorted(words)
    assert all(part in w for part, group in groups.items() for w in group)
    # a text without a role is searched for few parts instead of all roles
    assert len(regex.by_part(text.ranked_roles())) < 30 < len(text.ranked_roles())
    texts = ["xdata engineer iii", "soc analyst, ai engineer", "engineers", "qa", "nothing", "", None]
    held = [None if t is None else [w for w in words if w in t] for t in texts]
    assert [f if f is None else sorted(f) for f in evaluate(texts, lambda t: regex.listed_words(t, words))] == [
        h if h is None else sorted(h) for h in held]
    assert evaluate(texts, lambda t: regex.contains_any(t, words)) == [
        h if h is None else bool(h) for h in held]
    assert evaluate(texts, lambda t: regex.first_listed(t, {w: w.upper() for w in words})) == [
        h[0].upper() if h else None for h in held]
