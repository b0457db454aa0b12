"""Reply parsing: the layouts in any mix, and edge cases of each."""

from evidentia.schema import (CSV_COLUMNS, EXCLUSION_REASON, FIELD_COLUMNS, INCLUDE, QUESTION_COLUMNS, TITLE,
                              source_column)

NS = "Not specified"
Q1, Q1S = "1.1 Primary Stakeholders", "1.1 Primary Stakeholders - Source"
Q10 = "3.2 Feedback timing control"

def test_columns():
    assert len(CSV_COLUMNS) == 27
    assert CSV_COLUMNS[:5] == [TITLE, INCLUDE, EXCLUSION_REASON, Q1, Q1S]
    assert CSV_COLUMNS[-1] == "4.2 Measurement of agency - Source"


def _mixed(numbers):
    """A reply that gives each question in another layout, and what the rules read from it."""
    lines, want = ["**Include in Review**: Y"], {}
    for n in numbers:
        layout = [
            ([f"**{n}. Theme**: alpha value {n}", "", f"**Source**: place {n}"], f"alpha value {n}", f"place {n}"),
            ([f"{n}. **Theme**: beta value {n}", "not evidence"], f"beta value {n}", NS),
            ([f"{n}. Theme: gamma value {n}", f"Found in source: spot {n}"], f"gamma value {n}", f"spot {n}"),
            ([f"**{n}. Theme**: Which one is it?", f"**Answer**: delta value {n}", f"**Source**: page {n}"], f"delta value {n}", f"page {n}"),
        ][n % 4]
        lines += [*layout[0], "", "prose between the answers"]
        want[QUESTION_COLUMNS[n]], want[source_column(QUESTION_COLUMNS[n])] = layout[1:]
    return "\n".join(lines), want


def test_mixed_layouts_in_any_order(parse_one):
    for numbers in ([12, 7, 3, 10, 1, 5, 8, 2, 11, 4, 9, 6], [9, 4, 2], [11], []):
        text, want = _mixed(numbers)
        r = parse_one(text, "Any title")
        assert list(r) == CSV_COLUMNS and r[TITLE] == "Any title" and r[INCLUDE] == "Y"
        assert {c: r[c] for c in FIELD_COLUMNS} == {c: NS for c in FIELD_COLUMNS} | want


def test_rejected_paper_with_stray_answers(parse_one):
    r = parse_one("**Reason if excluded**: no pupils: only software\n7. Theme: kept all the same\n**Include in Review**: N")
    assert r[INCLUDE] == "N" and r[EXCLUSION_REASON] == "no pupils: only software"
    assert r[QUESTION_COLUMNS[7]] == "kept all the same"
    assert sum(r[c] != NS for c in FIELD_COLUMNS) == 1


def test_replies_under_ten_characters_say_nothing(parse_one):
    for text in [None, " \t\n ", "1. A: bcd", "   1. A: b   "]:
        r = parse_one(text, "T")
        assert r[TITLE] == "T" and all(r[c] == NS for c in CSV_COLUMNS[1:])
    assert parse_one("1. A: bcdef", "T")[Q1] == "bcdef"


def test_long_real_lines(parse_one):
    """Colons, stars and digits inside long answers stay as they are."""
    line = "ratio 3:1, see *note* 4. and 5: " + "word " * 2000 + "end"
    r = parse_one(f"**5. E**: {line}\n**Source**: {line}\nprose: 7 of 9\n**8. F**: {line}")
    assert r[QUESTION_COLUMNS[5]] == line.replace("**", "").strip() and r[source_column(QUESTION_COLUMNS[5])] == line
    assert r[QUESTION_COLUMNS[8]] == line


CASES = [
    ("**1. X**: ITS", NS, NS),                                   # too short for form 1
    ("1. **X**: ITS", "ITS", NS),                                # form 2 has no filter
    ("1. **X**:\nfiller line here", "", NS),                     # empty form 2 answer
    ("1. **X:** Teachers\nSource: p. 4", "Teachers", "p. 4"),    # form 3
    ("1. **X**: Not specified\n**Source**: q", NS, "q"),          # form 3 on the same line
    ("**1. X**: Alpha\n**Source**: s1\n**1. X**: Gamma", "Gamma", "s1"),  # source outlives
    ("1.5 Level: Primary", "Primary", NS),                       # prefix number match
    ("**1. X**: Is it students\n**Answer**: Pupils", "Pupils", NS),  # strict echo -> form 4
    ("**1. X**: Alpha\n**Source:** s1", "Alpha", NS),            # colon inside the bold
    ("**1. X**: Alpha\n**2. Y**: Beta\n**Source**: s2", "Alpha", NS),  # stop at next question
    ("**1. X**: Who knows\n**Answer**: abc\n**1. X**: zzz", NS, NS),   # short form-4 answer
    ("**1. X**: Can do\n**Answer**: Pupils\n**Source**: ev", "Pupils", "ev"),
]


def test_edge_cases(parse_one):
    for text, answer, source in CASES:
        r = parse_one(text)
        assert (r[Q1], r[Q1S]) == (answer, source), text


def test_no_prefix_collision(parse_one):
    r = parse_one("**10. X**: Alpha\nsome other line")
    assert r[Q1] == NS and r[Q10] == "Alpha"


def test_unicode_strip(parse_one):
    r = parse_one("　**1. X**: Learners here \n**Source**:\tp. 9 ")
    assert r[Q1] == "Learners here" and r[Q1S] == "p. 9"


def test_last_screening_wins(parse_one):
    r = parse_one("**Include in Review**: Y\n**Include in Review**: N\n**Reason if excluded**: r1")
    assert r[INCLUDE] == "N" and r[EXCLUSION_REASON] == "r1"
