"""Broken archives: files that break off, junk in front, magic inside payloads."""

import glob
import os

import pytest

from driftline.llm import warc

BODIES = ["<p>one</p>" * 20, "", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3, "x" * 5000, "tail"]


@pytest.fixture(scope="module")
def archive(corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "whole")
    rows = [(i, f"http://h/{i}", b) for i, b in enumerate(BODIES)]
    warc.write_archive(corpus.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), path)
    (file,) = glob.glob(os.path.join(path, "part-*"))
    with open(file, "rb") as f:
        return f.read()


def whole_records(data):
    """(record id, payload) by walking the lengths from the start."""
    at, out = 0, []
    while data.startswith(b"WARC/1.", at):
        head, blank, _ = data[at:].partition(b"\r\n\r\n")
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:] if b": " in x)
        if not blank or b"Content-Length" not in lines:
            break
        body = at + len(head) + 4
        end = body + int(lines[b"Content-Length"]) + 4
        if end > len(data):
            break
        out.append((lines[b"WARC-Record-ID"].decode(), data[body : end - 4].partition(b"\r\n\r\n")[2]))
        at = end
    return sorted(out)


def read(corpus, folder, data):
    folder.mkdir()
    (folder / "a.warc").write_bytes(data)
    return sorted((r["record_id"], bytes(r["payload"])) for r in warc.read_archive(corpus, str(folder)).collect())


def test_whole_file(corpus, archive, tmp_path):
    got = read(corpus, tmp_path / "w", archive)
    assert got == whole_records(archive) and len(got) == len(BODIES)


@pytest.mark.parametrize("cut", [-1, -4, -7, -60, 700, 1500, 10])
def test_a_file_that_breaks_off_yields_its_whole_records(corpus, archive, tmp_path, cut):
    data = archive[:cut]
    got = read(corpus, tmp_path / "c", data)
    assert got == whole_records(data) and len(got) < len(BODIES)


def test_cut_inside_a_payload_that_holds_the_magic(corpus, archive, tmp_path):
    at = archive.rindex(b"abc\r\n\r\n")
    for n in (at, at - 38):
        assert read(corpus, tmp_path / f"m{n}", archive[:n]) == whole_records(archive[:n])


def test_junk_in_front_yields_nothing(corpus, archive, tmp_path):
    assert read(corpus, tmp_path / "j", b"junk " + archive) == []


def test_a_wrong_length_ends_the_chain(corpus, archive, tmp_path):
    data = archive.replace(b"Content-Length: 5", b"Content-Length: 9", 1)
    assert read(corpus, tmp_path / "l", data) == whole_records(data)
