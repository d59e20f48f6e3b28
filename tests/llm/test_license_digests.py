import pytest

from skyledger.llm import license_digests as ld

NOTICE = "Licensed under the Apache License, Version 2.0."


@pytest.mark.parametrize(
    "text, whole, lines, names",
    [
        (NOTICE, "Apache-2.0", 1, "Apache-2.0"),
        ("LICENCED UNDER the apache licence v2.0!", "Apache-2.0", 1, "Apache-2.0"),
        ("Copyright (c) 2020 Some One\nAll rights reserved.\n\nReleased under the MIT Licence", "MIT", 1, "MIT"),
        (f"A text.\n{NOTICE}\nThis work is licensed under the GNU General Public License, version 3.\nEnd", None, 2, "Apache-2.0,GPL-3.0"),
        ("Copyright 1999 Me\n" + "The MIT License (MIT)\n" + ld.FULL["MIT"].replace(". ", ".\n\n").upper(), "MIT", 0, "MIT"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"),
        ("SPDX-License-Identifier: ISC", "ISC", 1, "ISC"),
        (f"not {NOTICE}", None, 0, ""),
        ("licensed under nothing", None, 0, ""),
        (None, None, 0, ""),
        ("", None, 0, ""),
    ],
)
def test_texts_and_lines(spark, frame, text, whole, lines, names):
    (r,) = ld.scan(frame([(1, text)], "doc_id long, text string"), ld.registry(spark)).collect()
    assert (r["license"], r["n_license_lines"], r["licenses"]) == (whole, lines, names)


@pytest.mark.parametrize("name, text", [*ld.FULL.items(), *ld.VARIANTS])
def test_full_texts_without_a_title(spark, frame, name, text):
    wrapped = "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + text.replace(". ", ".\n\n")
    got = ld.scan(frame([(1, wrapped), (2, text + " And more.")], "doc_id long, text string"), ld.registry(spark)).collect()
    assert [(r["license"], r["licenses"]) for r in sorted(got)] == [(name, name), (None, "")]


def test_a_text_of_ones_own_can_be_registered(spark, frame):
    known = ld.registry(spark, [("House", "House license: do as you like")])
    assert ld.scan(frame([(1, "HOUSE LICENCE -- do as you like")], "doc_id long, text string"), known).first()["license"] == "House"


def long_license(name, seed):
    """A license of the length of the Apache and Mozilla licenses."""
    import random

    dice = random.Random(seed)
    words = "license licensor contribution work source form you shall grant patent notice terms copyright of the to in any under".split()
    clauses = [" and ".join(dice.choices(words, k=60)) for _ in range(15)]
    return f"{name} License\nVersion 2.0\n\n" + "\n\n".join(f"{i}. {c}." for i, c in enumerate(clauses, 1))


def test_a_registry_from_a_folder_of_license_files(spark, frame, tmp_path):
    for name in ("Apache-2.0", "MPL-2.0"):
        (tmp_path / f"{name}.txt").write_text(long_license(name, name))
    known = ld.registry(spark, ld.texts_in(spark, str(tmp_path)))
    docs = [
        (1, "Copyright 2020 Some One\n" + long_license("Apache-2.0", "Apache-2.0").upper()),
        (2, long_license("MPL-2.0", "MPL-2.0").replace("license", "licence").replace(", ", " ")),
        (3, long_license("MPL-2.0", "Apache-2.0")),
        (4, long_license("MPL-2.0", "MPL-2.0") + " And more."),
    ]
    got = {r["doc_id"]: r["license"] for r in ld.scan(frame(docs, "doc_id long, text string"), known).collect()}
    assert got == {1: "Apache-2.0", 2: "MPL-2.0", 3: None, 4: None}


def test_a_large_registry_is_not_broadcast(spark, frame):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    found = ld.scan(frame([(1, NOTICE)], "doc_id long, text string"), ld.registry(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    for k in keys:
        spark.conf.unset(k)
    assert "Broadcast" not in plan


def test_awkward_rows(spark, awkward):
    got = ld.scan(awkward, ld.registry(spark)).collect()
    assert len(got) == awkward.count()
    assert {r["licenses"] for r in got} == {""}
    assert ld.scan(awkward.limit(0), ld.registry(spark)).collect() == []
