"""Notices at any place, one licence per place, against SQL and against windows at every word."""

import random
import re
from itertools import pairwise

import duckdb
import pytest

from compare import differences
from layerloom.llm import license_scan
from layerloom.llm.oracle import OP1

TEXT_OF = {}
for _name, _text in license_scan.TEMPLATES:
    TEXT_OF.setdefault(_name, []).append(_text)
GPL3 = next(t for t in TEXT_OF["gpl-3.0"] if t.startswith("This program"))
SHORT_GPL3 = next(t for t in TEXT_OF["gpl-3.0"] if t.startswith("This work"))
MIT = max(TEXT_OF["mit"], key=len)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))


def changed(text, share, seed):
    rng = random.Random(seed)
    return " ".join(prose(1, rng.random()) if rng.random() < share else w for w in text.split())


def wrapped(text, width=60):
    return re.sub(rf"(.{{1,{width}}})(?: |$)", r"\1\n", text).strip()


def found_in(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {}
    for r in license_scan.licence_notices(docs, **options).collect():
        out.setdefault(r["key"], []).append((r["start"], r["stop"], r["licence"], r["dice"]))
    return [sorted(out.get(i, [])) for i in range(len(texts))]


def licences(found):
    return [[f[2] for f in one] for one in found]


def test_notices_at_any_place(spark):
    half = GPL3.index("This program is distributed")
    two_paragraphs = f"{prose(30, 1)}.\n\n{GPL3[:half]}\n\n{GPL3[half:]}\n\n{prose(30, 2)}."
    bsd = max(TEXT_OF["bsd-3-clause"], key=len)
    texts = [
        two_paragraphs,
        f"{prose(20, 3)}. {SHORT_GPL3} {prose(20, 4)}.",
        f"{prose(12, 5)}\n{wrapped(prose(9, 6) + ' ' + GPL3 + ' ' + prose(9, 7))}\n{prose(12, 8)}",
        f"{prose(40, 9)}\n{bsd}\n{prose(5, 10)}",
        f"{prose(8, 11)} {MIT} {SHORT_GPL3} {prose(8, 12)} Licensed under CC BY 4.0. {prose(8, 13)}",
        prose(400, 14) + " the license of this software, version 3, is free; see the general terms. " + prose(50, 15),
    ]
    expected = [["gpl-3.0"], ["gpl-3.0"], ["gpl-3.0"], ["bsd-3-clause"], ["mit", "gpl-3.0", "cc-by-4.0"], []]
    found = found_in(spark, texts)
    assert licences(found) == expected
    assert all(dice == 1.0 for one in found for *_, dice in one)
    assert found[1] == [(20, 32, "gpl-3.0", 1.0)]


@pytest.mark.parametrize("share", [0.0, 0.04])
def test_every_template_is_found_under_its_own_name(spark, share):
    """Whole or with some words replaced, between prose; one licence for each place."""
    texts = [f"{prose(25, i)} {changed(t, share, i)} {prose(25, -i)}" for i, (_, t) in enumerate(license_scan.TEMPLATES)]
    found = found_in(spark, texts)
    for (name, text), one in zip(license_scan.TEMPLATES, found, strict=True):
        if share == 0 or len(text.split()) > 60:
            assert name in {f[2] for f in one}, (name, one)
            assert len(one) == 1


def test_repeated_notices_are_counted(spark):
    docs = spark.createDataFrame(
        [(1, f"{SHORT_GPL3}\n" * 3), (1, SHORT_GPL3), (2, (prose(6, 1) + " " + GPL3 + "\n") * 40)], "doc_id long, text string"
    )
    rows = {(r["key"], r["licence"]): (r["dice"], r["n_notices"]) for r in license_scan.licence_scan(docs).collect()}
    assert rows == {(1, "gpl-3.0"): (1.0, 4), (2, "gpl-3.0"): (1.0, 40)}


def every_window(text, templates, threshold):
    """Licences of any window of a template's length, at every word."""
    words = license_scan.template_words(text)
    out = set()
    for name, template in templates:
        own = license_scan.template_words(template)
        wanted = set(pairwise(own))
        for start in range(max(len(words) - len(own) + 1, 1)):
            grams = set(pairwise(words[start : start + len(own)]))
            if grams and 2 * len(grams & wanted) / (len(grams) + len(wanted)) >= threshold:
                out.add((name, start))
    return out


def test_no_licence_that_windows_at_every_word_find_is_lost(spark):
    """Each matching window overlaps a notice that is reported, and single-template scans lose no licence."""
    rng = random.Random(5)
    texts = []
    for i in range(24):
        parts = [prose(rng.randint(0, 30), 100 + i)]
        for _ in range(rng.randint(1, 3)):
            _, text = rng.choice(license_scan.TEMPLATES)
            parts += [changed(text, rng.choice([0, 0, 0.02, 0.05, 0.08]), rng.random()), prose(rng.randint(0, 25), rng.random())]
        texts.append(rng.choice([" ", "\n", "\n\n"]).join(parts))
    found = found_in(spark, texts)
    for text, one in zip(texts, found, strict=True):
        for name, template in license_scan.TEMPLATES:
            length = len(license_scan.template_words(template))
            for _, start in every_window(text, ((name, template),), 0.8):
                assert any(s < start + length and start < e for s, e, *_ in one), (name, start, one)


def test_odd_layouts_match_sql(spark):
    half = len(GPL3) // 2
    texts = [
        f"\n\n\n{SHORT_GPL3}\r\n \t\r\n---\n{MIT}\n\n",
        wrapped(MIT, 30),
        f"{GPL3[:half]}\n***\n{GPL3[half:]}",
        f"x {changed(MIT, 0.06, 2)} {changed(GPL3, 0.05, 3)} y",
        "Released under the MIT License. " * 50,
        "Released under the\nMIT License",
        f"Ünïcode wörds {SHORT_GPL3.upper()} 中文字符",
        "license",
        "\n",
        "",
        None,
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(p) for p in enumerate(texts)])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = license_scan.licence_scan(docs).withColumnRenamed("key", "doc_id")
    assert differences(out, con, OP1) is None
    assert {r["doc_id"]: r["n_notices"] for r in out.where("licence = 'mit'").collect()}[4] == 50


def test_telling_bigrams_are_in_every_match():
    telling = {(a, b) for a, b, *_ in license_scan.telling_bigrams(license_scan.TEMPLATES, 0.8)}
    for _, text in license_scan.TEMPLATES:
        grams = set(pairwise(license_scan.template_words(text)))
        left = len(grams - telling)
        assert 2 * left / (left + len(grams)) < 0.8
