from __future__ import annotations

import random
import string

from pluvio.llm import secrets

from .test_secrets import DICTIONARY

BASE62 = string.ascii_letters + string.digits


def _novel(text):
    return [text[f["start"]:f["end"]] for f in secrets.Scanner(DICTIONARY).scan(text) if f["kind"] == "novel"]


def _random(size, alphabet=BASE62, seed=5):
    return "".join(random.Random(seed).choices(alphabet, k=size))


def test_candidates_up_to_the_distance_on_either_side():
    key = _random(32)
    for gap in (1, 52, 53, 64):
        assert _novel(f"passphrase{' ' * gap}{key}") == [key]
        assert _novel(f"{key}{' ' * gap}passphrase") == [key]
    assert _novel(f"passphrase{' ' * 65}{key}") == _novel(f"{key}{' ' * 65}passphrase") == []


def test_every_line_of_a_key_body():
    lines = [_random(64, BASE62 + "+/", seed) for seed in range(8)]
    body = "\n".join(lines)
    assert _novel(f"-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----\n") == lines
    assert _novel(f"a line\n{body}\n") == []


def test_long_upper_case_hex():
    for size in (64, 256, 512):
        key = _random(size, "0123456789ABCDEF")
        assert _novel(f"signing key {key}") == [key]
