"""Operator 9: payloads of every build, planted in every encoding among
decoys, are found where they stand and nowhere else."""

import base64
import json
import random

import pytest

from basketry.llm import secrets


def b64(data: bytes, url=False) -> str:
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def der(tag: int, body: bytes) -> bytes:
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x80 | 2]) + n.to_bytes(2, "big")) + body


def field(data: bytes) -> bytes:
    return len(data).to_bytes(4, "big") + data


RSA = der(0x30, b"".join(der(2, bytes([1] * n)) for n in (1, 40, 3, 40, 20, 20, 20, 20, 20)))
MANY = der(0x30, b"".join(der(2, b"\x01\x02") for _ in range(60)))  # more than 32 elements
SSH = field(b"ssh-ed25519") + field(bytes(range(32)))
TEXTS = [b"password=hunter2hunter2\n", b"A=1\nAPI_KEY: abcdefgh12345\nB=2\n", "höhe=3\ttoken = geheim-geheim-9\r\n".encode(),
         b"AKIA" + b"ABCDEFGH12345678", b64(b"secret: \"deepdeepdeep1\" and more").encode() + b"\n",
         b64(b64(b64(b"password=threelevels99 " * 2).encode()).encode()).encode()]


@pytest.mark.parametrize("payload,kind", [(RSA, "private_key"), (MANY, "private_key"), (SSH, "ssh_key"), *[(t, "encoded") for t in TEXTS]])
def test_payload_is_found_in_every_encoding(payload, kind):
    rng = random.Random(3)
    for run in (b64(payload), b64(payload, url=True), payload.hex(), payload.hex().upper()):
        if len(run) < 24:
            continue
        before = " ".join(rng.choice(["lorem", "ipsum", "dolor.", "é"]) for _ in range(rng.randint(0, 30)))
        text = f"{before} <{run}> rest of the text"
        at = text.index(run)
        found = [s for s in secrets.method_spans(text) if s[2] == kind]
        assert found == [(at, at + len(run), kind)], (payload[:20], run[:30])


def test_short_signed_token_passes_the_first_filter(spark):
    header = b64(json.dumps({"alg": "none"}, separators=(",", ":")).encode(), url=True)
    token = f"{header}.{b64(b'{}', url=True)}."
    assert all(len(p) < 24 for p in token.split("."))
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(b64(RSA)[i:i + 16] for i in range(0, len(b64(RSA)), 16)) + "\n-----END PRIVATE KEY-----"
    docs = spark.createDataFrame([(1, f"x {token} y"), (2, pem), (3, "no secrets here. None.at all.")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs).collect()}
    assert got[1] == f"signed_token:2:{2 + len(token)}" and got[2] == f"private_key:0:{len(pem)}" and got[3] == ""


def test_decoys_are_left_alone():
    rng = random.Random(11)
    for _ in range(300):
        noise = bytes(rng.randrange(256) for _ in range(rng.randint(18, 200)))
        cut = RSA[:rng.randint(20, len(RSA) - 1)]
        prose = b"a perfectly ordinary sentence without anything in it " * rng.randint(1, 3)
        for data in (noise, cut, RSA + b"x", SSH[:-1], prose):
            assert secrets.method_spans(f"v {b64(data)} w") == [], data[:30]


def test_long_runs_take_linear_time():
    text = "A" * 400_000 + " " + "ab" * 100_000 + "." + "x-" * 100_000
    assert secrets.method_spans(text) == []


def test_many_spans_inside_one_are_reported_once():
    inner = "\n".join(f"password=value{i:08d}" for i in range(50)).encode()
    run = b64(inner)
    assert secrets.method_spans(f"x {run} y") == [(2, 2 + len(run), "encoded")]
