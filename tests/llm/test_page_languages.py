"""Languages of the whole table of pages against a plain version."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import langid
from plumbline.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def grams(text):
    """Buckets of trigrams of folded bytes around a letter, without letters that stand alone."""
    data = bytes(32 if b < 128 and not chr(b).isalpha() else b + 32 if 65 <= b <= 90 else b for b in b" " + text.encode() + b"   ")
    out = []
    for x, y, z in zip(data, data[1:], data[2:]):
        if y != 32 and not (x == 32 and z == 32):
            out.append(((x | y << 8 | z << 16) * 0x9E3779B1 & 0xFFFFFFFF) >> 16)
    return out


def evidence(page):
    host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", page["url"])[1].lower()
    declared = re.search(r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", page["html"])[1].lower()
    text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", page["html"])
    return declared, host, host.split(".")[-1], grams(text)


def test_every_page_by_all_evidence(spark):
    pages = {r["page_id"]: evidence(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len({p[1] for p in pages.values()}) > len({".".join(p[1].split(".")[-2:]) for p in pages.values()}) > 1
    counts = np.zeros((4, langid.BUCKETS))
    for declared, _, _, found in pages.values():
        np.add.at(counts[langid.LANGUAGES.index(declared)], found, 1)
    profile = langid.with_other(counts).astype(float)
    names = (*langid.LANGUAGES, langid.OTHER)
    prior = np.array([0, 0, 0, 0, math.log(langid.OTHER_PRIOR)])
    likelihood = {i: profile[:, p[3]].sum(axis=1) for i, p in pages.items()}
    suggested = {i: int(np.argmax(x + prior)) for i, x in likelihood.items()}

    def tally(key):
        out = {}
        for i, p in pages.items():
            out.setdefault(key(p), np.zeros(5))[suggested[i]] += 1
        return out

    def emission(key):
        table = tally(key)
        total = sum(table.values()) + 0.5 * (len(table) + 1)
        return {k: np.log((v + 0.5) / total) for k, v in table.items()}

    declared, suffix = emission(lambda p: p[0]), emission(lambda p: p[2])
    domain = lambda p: ".".join(p[1].split(".")[-2:])
    hosts, domains, total = tally(lambda p: p[1]), tally(domain), Counter(suggested.values())
    everywhere = np.array([(total[x] + 1) / (len(pages) + 5) for x in range(5)])
    got = {r["page_id"]: r for r in QUERIES["op10_page_language"](spark, SF_DIR).collect()}
    assert got.keys() == pages.keys()
    for i, p in pages.items():
        d, h = domains[domain(p)], hosts[p[1]]
        share = (d + langid.LENT * everywhere) / (d.sum() + langid.LENT)
        share = (h + langid.LENT * share) / (h.sum() + langid.LENT)
        n = len(p[3])
        sums = langid.INDEPENDENT / (langid.INDEPENDENT + n) * likelihood[i] + prior
        sums = sums + declared[p[0]] + suffix[p[2]] + np.log(share)
        best = int(np.argmax(sums))
        assert (got[i]["declared"], got[i]["language"], got[i]["n_grams"]) == (p[0], names[best], n)
        assert got[i]["posterior"] == pytest.approx(1 / np.exp(sums - sums[best]).sum(), rel=1e-6)
        assert got[i]["kept"] == (best < 4)
