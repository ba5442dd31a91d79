"""The README's coverage table agrees with its open items."""

import os
import re

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def test_unclaimed_queries_are_marked_in_the_coverage_table():
    with open(README, encoding="utf-8") as f:
        text = f.read()
    item = re.search(r"## Open items\n\n\* (.*?) stay registered", text, re.S)[1]
    unclaimed = set(re.findall(r"`(\w+)`", item))
    marked = set(re.findall(r"(?m)^\| \w+ \| `(\w+)` \| .*\(not claimed\) \|$", text))
    assert unclaimed == marked and len(marked) == 5
