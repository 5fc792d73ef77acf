"""Added spans of the secret scan: whole names, whole sums, constants, against a plain version, linear time."""

from __future__ import annotations

import random
import re
import time

import pytest

from ledgerloom.llm import secret_scan as s


def literals(text: str) -> set[tuple[str, str]]:
    return {(text[a:b], name) for kind, a, b, _, name, _ in s.spans_of(text) if kind == "literal"}


@pytest.mark.parametrize("pad", [0, 1, 100, 5000])
def test_names_as_far_as_they_go(pad):
    line = "db_password" + " " * pad + "=> \"kd83hf72hs8dkq1\""
    assert literals(line) == {("kd83hf72hs8dkq1", "db_password")}
    long = "x" * pad + "_password"
    assert literals(f"{long} := 'kd83hf72hs8dkq1'") == {("kd83hf72hs8dkq1", long)}
    assert literals(f"\n'db_password'{' ' * pad}: `kd83hf72hs8dkq1`") == {("kd83hf72hs8dkq1", "db_password")}
    assert not literals(f"password'{' ' * pad}=> 'kd83hf72hs8dkq1'")


def test_sums_count_as_a_whole():
    assert literals('password = "abc12" + "def34"') == {("abc12", "password"), ("def34", "password")}
    assert literals('a = "abc12"\nb = "def34"\nmy_token = a + b') == {("abc12", "my_token"), ("def34", "my_token")}
    assert literals('a = "abc12"\nb = a + "def34"\nc = b\nsecret = c') == {("abc12", "secret"), ("def34", "secret")}
    assert not literals('title = "abc12" + "def34"')
    assert not literals('password = "ab" + "cd"')
    assert not literals('password = "abc12 " + "and def34"')  # a text, no key
    # circles, and a name that is assigned twice
    assert literals('a = b\nb = a\nsecret = a + "abc12def34"') == {("abc12def34", "secret")}
    assert literals('k = "kd83hf72hs8d"\nk = "zz93jf72hs81"\ntoken = k') == {("kd83hf72hs8d", "token"), ("zz93jf72hs81", "token")}


def plain_literals(lines: list[tuple[str, str, bool]]) -> set[tuple[str, str]]:
    """(literal, name) of single assignments (name, value, whether it is a literal), by plain search."""
    bound: dict[str, list] = {}
    for place, (name, value, literal) in enumerate(lines):
        bound.setdefault(name, []).append((place, value, literal))
    reach: dict[int, set[str]] = {}
    for name in bound:
        todo, seen = [name], set()
        while todo:
            at = todo.pop()
            if at in seen:
                continue
            seen.add(at)
            for place, value, literal in bound[at]:
                if literal or value not in bound:
                    reach.setdefault(place, set()).add(name)
                else:
                    todo.append(value)
    found = set()
    for place, names in reach.items():
        value = lines[place][1]
        best = max(sorted(names), key=s.name_weight)
        if s.name_weight(best) * s.literal_weight(value) >= s.THRESHOLD:
            found.add((value, best))
    return found


def test_constants_against_a_plain_search():
    rng = random.Random(6)
    names = ["a", "b", "c", "note", "password", "api_key", "token_count", "auth", "url"]
    met = 0
    for _ in range(400):
        lines = []
        for n in range(rng.randint(1, 9)):
            literal = rng.random() < 0.5
            value = f"k{n}x{rng.randrange(10**9)}Q" if literal else rng.choice([*names, f"free_{n}_value"])
            lines.append((rng.choice(names), value, literal))
        text = "\n".join(f'{n} = "{v}"' if literal else f"{n} = {v}" for n, v, literal in lines)
        wanted = plain_literals(lines)
        assert literals(text) == wanted, text
        met += len(wanted)
    assert met > 200


@pytest.mark.parametrize(
    "line", ["a{0} = a{1}", "a = b\nb = a", "a{0} = a{1} + 'x{0}'", "password: 'k{0}93jf72hs81'", "a.b{0}: c : d = e"]
)
def test_a_megabyte_of_assignments_takes_seconds(line):
    text, n = [], 0
    while sum(map(len, text[-1:])) * len(text) < 1_000_000:
        text.append(line.format(n, n + 1))
        n += 1
    text = "\n".join(text)
    began = time.perf_counter()
    found = s.spans_of(text)
    assert time.perf_counter() - began < 30
    assert bool(found) == bool(re.search("password", text))
