"""Packages by Spark against the digests of files read one by one."""

import hashlib

import pytest

from claimgrid import packages


@pytest.fixture
def folder(tmp_path):
    top = tmp_path / "pack é [1]{2}*?"
    for name, content in {"a.txt": b"a", "empty": b"", "deep/er/b c.bin": bytes(range(256)) * 20_000, "deep/é.txt": "é".encode(), "key=1/x": b"x", "deep/100%20+.txt": b"%", "_SUCCESS": b"", ".hidden": b"h"}.items():
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(content)
    return top


def plain(folder):
    """Lines of a manifest, of what isn't hidden."""
    files = [p for p in folder.rglob("*") if p.is_file() and not p.name.startswith((".", "_")) and p.name != packages.MANIFEST]
    named = sorted((p.relative_to(folder).as_posix(), hashlib.md5(p.read_bytes()).hexdigest()) for p in files)
    return [f"{digest}  {name}" for name, digest in named]


@pytest.mark.parametrize("scheme", ["", "file://", "file:"])
def test_manifest_is_that_of_files_read_one_by_one(spark, folder, scheme):
    uri = f"{scheme}{folder}"
    assert not packages.packed(spark, uri)
    packages.package(spark, uri)
    assert packages.packed(spark, uri)
    assert (folder / packages.MANIFEST).read_text().splitlines() == plain(folder) and len(plain(folder)) == 6
    assert packages.changed(spark, uri).count() == 0
    assert sorted(packages.digests(spark, uri, stream=False).collect()) == sorted(packages.digests(spark, uri).collect())
    with pytest.raises(FileExistsError):
        packages.package(spark, uri)
    assert not [p for p in folder.iterdir() if p.name.startswith("_manifest")]


def test_states(spark, folder):
    packages.package(spark, str(folder))
    (folder / "a.txt").write_text("b")
    (folder / "empty").unlink()
    (folder / "new").write_text("n")
    for stream in (True, False):
        found = {r["name"]: r["state"] for r in packages.states(spark, str(folder), stream).collect()}
        assert found == {"a.txt": "changed", "empty": "missing", "new": "new", "deep/er/b c.bin": "same", "deep/é.txt": "same", "key=1/x": "same", "deep/100%20+.txt": "same"}
    assert {r["name"] for r in packages.changed(spark, str(folder)).collect()} == {"a.txt", "empty"}
    packages.package(spark, str(folder), overwrite=True)
    assert packages.changed(spark, str(folder)).count() == 0 and (folder / packages.MANIFEST).read_text().splitlines() == plain(folder)


def test_copies_of_files_and_folders(spark, folder, tmp_path):
    target = tmp_path / "target"
    packages.package(spark, f"file://{target}", sources=[str(folder), f"file://{folder}/a.txt"])
    assert (target / "a.txt").read_bytes() == b"a" and (target / folder.name / "deep/er/b c.bin").stat().st_size == 256 * 20_000
    assert (target / packages.MANIFEST).read_text().splitlines() == plain(target)
    assert not [p for p in target.rglob(".*") if not p.name.endswith(".crc")]


def test_no_files(spark, tmp_path):
    packages.package(spark, str(tmp_path / "none"))
    assert (tmp_path / "none" / packages.MANIFEST).read_text() == "" and packages.states(spark, str(tmp_path / "none")).count() == 0
