"""The quick look at a body loses nothing that the layout finds."""

import random

from strataframe.llm import scans

TEXT = [
    "The pump is switched on when the pressure in the line that leads to the tank falls below",
    "the value that is given in the table, and the valve at its end stays open until the motor",
    "has stopped for ten seconds at least, so that no water is left in the housing of the unit",
    "or in the hose, where it would freeze in a cold night and then break the seal of the valve",
]


def body(*headings):
    """Pages with a heading line each; no line of the text comes twice."""
    pages = [[f"{x} {w}" for x in TEXT] for w in ("again", "then", "later")]
    return "\n".join(x for h, p in zip(headings, pages) for x in (*p[:2], h, *p[2:]))


def test_heading_lines_that_are_misread_differently():
    # the document's number and name are misread on each page, each time in another way
    text = body("H0using rnanual, first draft of the group", "Hou5ing manual, first draft of the group", "Housing manuaI, fir5t draft of the group")
    lines, kinds = scans.lines_of(text, "M1000007 Intake Housing")
    assert "header" in kinds and not any("draft" in x for x in lines)


def test_long_heading_lines_that_come_twice():
    heading = "Housing manual, revised edition for workshopmasters"
    assert 40 < len(heading) <= 60
    lines, kinds = scans.lines_of(body(heading, heading), "M1000007 Intake Housing")
    assert "header" in kinds and heading not in lines


def test_the_quick_look_finds_what_the_layout_finds():
    random.seed(3)
    pool = ["Pump manual", "Purnp manual", "M1000007", "MI0OOOO7 x", "- 3 -", "Page 4 of 9", "12", "Intake hou5ing notes", "Intake housing notes", "", *TEXT]
    for _ in range(400):
        text = random.choice(["\n", "\r", "\r\n"]).join(random.choice(pool) for _ in range(random.randint(4, 24)))
        lines, kinds = scans.layout(text, "M1000007 Pump Housing")
        if kinds:
            assert scans.lines_of(text, "M1000007 Pump Housing") == (lines, kinds)


def test_bodies_without_noise_stay_one_piece():
    text = "\n".join([*TEXT, "A note", "Other words"])
    assert scans.lines_of(text, "M1000007 Pump") == ([text], set())
