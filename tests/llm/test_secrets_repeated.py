from __future__ import annotations

import random
import string

from pluvio.llm import secrets

from .test_secrets import DICTIONARY, KEY


def _novel(text, dictionary=DICTIONARY):
    return [text[f["start"]:f["end"]] for f in secrets.Scanner(dictionary).scan(text) if f["kind"] == "novel"]


def _random(size, seed=1):
    return "".join(random.Random(seed).choices(string.ascii_letters + string.digits, k=size))


def test_a_secret_on_two_adjacent_lines_is_reported_twice():
    for key in (KEY, *(_random(n) for n in (20, 32, 64))):
        assert _novel(f"signing key {key}\nsigning key {key}\n") == [key, key]
        assert _novel(f"signing key {key}\n" * 9) == [key] * 9
    assert _novel("session id database_connection_identifier_1\n" * 2) == []


def test_the_value_of_an_assignment_used_again_is_reported():
    key = _random(32)
    assert _novel(f"export SIGNING_KEY={key}\nrun --signature {key}\n") == [f"={key}", key]
