"""Secrets in compressed data of any size and number of members, in time that grows with the data."""

import base64
import bz2
import gzip
import lzma
import time
import zlib

import pytest

from probelake.llm import secrets

SECRET = b'password = "abcdefghijklmnop"'
PACKERS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress}


def kinds(text):
    return {kind for _, kind, _ in secrets.scan(text)[1]}


def coded(data):
    return "x " + base64.b64encode(data).decode() + " y"


@pytest.mark.parametrize("name", PACKERS)
def test_large_layers_are_scanned_whole(name, monkeypatch):
    monkeypatch.setattr(secrets, "PIECE", 50_000)
    pack = PACKERS[name]
    for filler in (b"lorem ipsum, dolor sit amet ", b"no place to cut it here\n", "日本, ".encode()):
        for middle in (SECRET, base64.b64encode(pack(SECRET)), SECRET.replace(b"a", b"%61")):
            data = filler * 9000 + b" " + middle + b" " + filler * 9000
            _, found, cut = secrets.scan(coded(pack(data)))
            assert found == [(2, 0, 2 + len(base64.b64encode(pack(data))))]


@pytest.mark.parametrize("at", range(0, 120, 7))
def test_a_secret_over_the_end_of_a_piece(at, monkeypatch):
    monkeypatch.setattr(secrets, "PIECE", 1000)
    data = b"word, " * 150 + b" " * at + SECRET + b", word" * 400
    assert kinds(coded(gzip.compress(data))) == {0}


def test_pieces_are_the_whole_stream(monkeypatch):
    monkeypatch.setattr(secrets, "PIECE", 100)
    monkeypatch.setattr(secrets, "LONGEST", 1000)
    monkeypatch.setattr(secrets, "OVERLAP", 50)
    stream = [b"ab, cd" * 7, b"", b"x" * 90, b", y" * 100]
    found = list(secrets._pieces(stream))
    assert b"".join(p for p, _ in found) == b"".join(stream) and not any(cut for _, cut in found)
    found = list(secrets._pieces([b"z" * 700, b"z" * 700, b"z" * 100]))
    assert found[0] == (b"z" * 1400, True) and sum(len(p) for p, _ in found) == 1500 + 50


@pytest.mark.parametrize("name", PACKERS)
def test_members_broken_data_and_depth(name):
    pack = PACKERS[name]
    assert kinds(coded(pack(b"first") + pack(b"second") + b"\0\0" + pack(SECRET))) == {0}
    deep = SECRET
    for _ in range(4):
        deep = pack(deep)
    assert kinds(coded(deep)) == {0}
    assert kinds(coded(pack(SECRET * 50)[:-4])) == {0}
    assert kinds(coded(pack(b"nothing") + b"garbage" * 9)) == set()


def test_time_grows_with_the_data():
    def seconds(data):
        text = coded(data)
        start = time.perf_counter()
        secrets.scan(text)
        return time.perf_counter() - start

    starts = (b"x^" + b"some text that goes on " * 6) * 3000
    members = b"".join(gzip.compress(b"member %d" % i) for i in range(4000))
    for data in (starts, members):
        seconds(data)
        assert seconds(data * 4) < 10 * seconds(data) + 0.5
