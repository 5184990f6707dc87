"""Notices that no single paragraph holds."""

from quillon.llm.licenses import TEMPLATES, Scanner, parts_of


def matches(text):
    scanner = Scanner(TEMPLATES, 0.8)
    return {m[0] for p in parts_of(text) if (m := scanner.best(p))}, {(n, d) for n, d, _ in scanner.runs(text)}


def test_notice_of_several_paragraphs_in_a_longer_text():
    whole = {n: t for n, t in TEMPLATES}
    mit = next(t for n, t in TEMPLATES if n == "MIT" and t.startswith("Permission"))
    cut = mit.replace(" The above copyright", "\n\nThe above copyright").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    code = "\n\n".join(f"def number_{i}():\n    return the_value_of({i})" for i in range(200))
    parts, runs = matches(f"A long article.\n\n{cut}\n\n{code}")
    assert (parts, runs) == (set(), {("MIT", 1.0)})
    gpl = whole["GPL-3.0-or-later"].replace(" This program is distributed", "\n\nThis program is distributed")
    assert matches(f"{code}\n\n{gpl}\n\n{code}") == (set(), {("GPL-3.0-or-later", 1.0)})
    # a notice of one paragraph is no run as well
    assert matches(f"Some words.\n\nReleased under the MIT License.\n\n{code}") == ({"MIT"}, set())


def test_words_may_be_split_by_tabs():
    assert matches("Released\tunder\tthe\tMIT\tLicense.")[0] == {"MIT"}


def test_copyright_clause_leaves_the_rest_of_its_line():
    assert matches("Copyright 2020 X. Licensed under the MIT License.")[0] == {"MIT"}


def test_texts_that_are_passed_over_have_no_match():
    scanner = Scanner(TEMPLATES, 0.8)
    for name, text in TEMPLATES:
        assert scanner.may_match(f"Some words before. {text}\nAnd after.")
        assert (scanner.best(text) or (None,))[0] == name
    assert not scanner.may_match("nothing of the kind")
