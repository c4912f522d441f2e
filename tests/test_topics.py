"""Topics of whole texts against a plain search."""

import os
import re
from collections import Counter
from itertools import combinations

import pandas as pd
import pytest

from humusgrid.operators.topics import TOPICS, text_topics
from humusgrid.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_text_topics(spark):
    rows = [(1, "Торф и PEAT" + " x" * 20000 + " Засоление и чернозёмы, ЧЕРНОЗЕМ; soil\npH"), (2, "asodic, вглей"), (2, "Sodic глей"), (3, None), (4, "")]
    got = sorted(tuple(r) for r in text_topics(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect())
    assert got == [(1, "chernozem_steppe"), (1, "peat_wetlands"), (1, "salinity_solonetz"), (2, "hydromorphism_gley"), (2, "salinity_solonetz")]


def test_topic_queries_equal_plain_search(spark):
    d = pd.read_parquet(f"{DATA}/documents.parquet", columns=["doc_id", "text", "document_id"])
    found, corpora = {}, {}
    for key, text, document in zip(d.doc_id, d.text, d.document_id):
        has = {n for n, p in TOPICS.items() if isinstance(text, str) and re.search(p, text.casefold(), re.I | re.S)}
        found.setdefault(key, set()).update(has)
        corpora.setdefault(key, set()).add(document.split(":")[0] if isinstance(document, str) else None)
    counts = Counter((c, n) for key, has in found.items() for n in has for c in corpora[key])
    assert {(r["corpus"], r["topic"]): r["documents"] for r in catalog.QUERIES["text_topic_counts"](spark, DATA).collect()} == counts
    sizes = Counter(n for has in found.values() for n in has)
    pairs = Counter(p for has in found.values() for p in combinations(sorted(has), 2))
    got = {(r["item_a"], r["item_b"]): (r["shared"], r["jaccard"]) for r in catalog.QUERIES["text_topic_pairs"](spark, DATA).collect()}
    assert got == {(a, b): (n, pytest.approx(n / (sizes[a] + sizes[b] - n))) for (a, b), n in pairs.items()}
