"""Documents that are a licence in full."""

import textwrap
from pathlib import Path

import pytest

from plumbline.llm import licences

FOLDER = Path(licences.__file__).parent / "licence_texts"
SHORT = ["MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Zlib"]


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licences.scanned(docs, licences.known_digests(spark)).collect()
    return [r["licence"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_whole_licences_as_they_are(spark):
    files = sorted(FOLDER.glob("*.txt"))
    assert {"Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "Unlicense", *SHORT} <= {f.stem for f in files}
    assert found(spark, [f.read_text() for f in files]) == [f.stem for f in files]
    assert found(spark, [f.read_text().upper().replace(" ", "  ") for f in files]) == [f.stem for f in files]


@pytest.mark.parametrize("width", [40, 72, 100_000])
def test_other_wrapping_case_and_holder(spark, width):
    texts = []
    for name in SHORT:
        title, claim, *rest = (FOLDER / f"{name}.txt").read_text().strip().split("\n\n")
        rest = "\n\n".join(textwrap.fill(p, width) for p in rest)
        texts += [f"{title}\n\nCopyright (c) 2019 Jane Doe\n\n{rest}", f"Copyright 2020-2024, Firm Ltd. All rights reserved.\n{rest.lower()}", rest]
        texts.append(f"{title}\n\nCopyright (c) 2019, Jane Doe\nAll rights reserved.\n\n{rest}")
    assert found(spark, texts) == [n for n in SHORT for _ in range(4)]


def test_headers_of_files(spark):
    assert found(spark, [textwrap.fill(t, 60) for _, t in licences.HEADERS]) == [n for n, _ in licences.HEADERS]
    apache = (FOLDER / "Apache-2.0.txt").read_text()
    paragraphs = [" ".join(p.split()) for p in apache.split("\n\n")]
    assert found(spark, ["\n".join(paragraphs)]) == ["Apache-2.0"]
