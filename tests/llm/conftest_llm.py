"""Plain helpers of the corpus tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
