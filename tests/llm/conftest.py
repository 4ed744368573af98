import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


class Groups:
    """Union-find for the brute-force versions."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


@pytest.fixture()
def groups():
    return Groups


DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    def make(rows, ddl=DOC_DDL):
        return spark.createDataFrame(rows, ddl)
    return make


def doc(i, text, source="s0", lang="en"):
    return (i, text, lang, source, len(text or ""))
