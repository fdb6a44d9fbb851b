"""Licence notices: versions and variants apart, one match per occurrence."""

import pytest

from driftline.llm import licenses
from driftline.llm.common import WordHashes

ALL = licenses.TEMPLATES + licenses.family_templates()
INDEX = licenses.Index(ALL)


def found(text):
    words = licenses.words_of(text)
    return [(m[1], m[2], m[3]) for m in licenses.scan_text(words, WordHashes().of(words), INDEX, licenses.CONTAINMENT)]


def names(text):
    return {m[0] for m in found(text)}


def test_every_template_is_found_under_its_own_name_only():
    for name, text in ALL:
        assert names(f"one two three {text} four five six") == {name}, text


@pytest.mark.parametrize(
    "text, want",
    [
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under the GNU General Public License, version 4.", set()),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1", {"LGPL-2.1"}),
        ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", {"CC-BY-3.0"}),
        ("Licensed under CC BY-NC-SA 4.0.", {"CC-BY-NC-SA-4.0"}),
        ("Licensed under CC BY-NC-SA 9.0.", set()),
        ("Licensed under the Apache License, Version 1.1.", set()),
    ],
)
def test_versions_and_variants(text, want):
    assert names(text) == want


def test_a_few_changed_words_are_no_obstacle_but_the_variant_is():
    text = dict(ALL)["AGPL"]
    assert names(text.replace("This program", "The program")) == {"AGPL"}
    assert "AGPL" not in names(text.replace("Affero", "Lesser"))


@pytest.mark.parametrize("copies", [1, 2, 3, 7])
def test_adjoining_notices_are_matches_of_their_own(copies):
    for name, text in ALL[2:6]:
        n = len(licenses.words_of(text))
        whole = [m for m in found(" ".join([text] * copies)) if m[0] == name and m[2] == n]
        assert [m[1] for m in whole] == [i * n for i in range(copies)]


def test_reordered_parts_still_count_once():
    words = licenses.TEMPLATES[3][1].split()
    assert names(" ".join(words[30:] + words[:30])) == {"MIT"}
