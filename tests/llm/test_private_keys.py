"""Whole private keys are found and masked."""

from __future__ import annotations

import random
import string

import pytest

from parvis.llm import secrets

BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"


def body(gap, n=700):
    rng = random.Random(5)
    key = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=n)) + "=="
    return gap.join(key[a:a + 64] for a in range(0, len(key), 64))


@pytest.mark.parametrize("gap", ["\n", "\r\n", "\n  ", " ", "\\n"])
@pytest.mark.parametrize("header", ["", "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B"])
def test_nothing_of_a_key_is_left(spark, gap, header):
    if header and gap == " ":
        pytest.skip("a header ends with its line")
    key = gap.join([BEGIN, *([header, ""] if header else []), body(gap), END])
    found = [s for s in secrets.Scanner().spans(f"é one {key} two\nthree") if s[1] == 8]
    assert [(a, b) for a, _, b in found] == [(6, 6 + len(key))]


def test_keys_without_an_end_and_two_keys(spark):
    key = "\n".join([BEGIN, body("\n")])
    assert [s[2] for s in secrets.Scanner().spans(f"{key}\nthe rest of it") if s[1] == 8] == [len(key)]
    short = "\n".join([BEGIN, body("\n", 129).rstrip("="), ""])
    assert [s[2] for s in secrets.Scanner().spans(f"{short}the rest") if s[1] == 8] == [len(short) - 1]
    two = f"{key}\n{END}\n and {key}\n{END} end"
    df = spark.createDataFrame([(1, two)], "doc_id long, text string")
    assert secrets.without_secrets(df).first()["text"] == "<secret>\n and <secret> end"
    assert secrets.Scanner().spans(f"{BEGIN} is how keys begin")[0][2] == len(BEGIN)
