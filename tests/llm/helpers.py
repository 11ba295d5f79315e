"""What the tests of the corpus operators share."""

import re

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def doc(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text))


class Groups:
    """Union of sets, for brute-force components."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
