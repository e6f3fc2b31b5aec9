"""SRC-4, FLT-5, AGG-4, AGG-5 from listings and the manifest."""

import os
import shutil

import pytest

from metroframe.sources import manifest as M
from metroframe.sources import snapshot as S


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def root(tmp_dir):
    base = f"{tmp_dir}/raw"
    for date in ("231231", "240105"):
        for district in ("강남구", "중구"):
            put(f"{base}/request_date={date}/district={district}/a.csv", f"name,n\n{district}{date},1\n")
    put(f"{base}/request_date=240612/district=강남구/a.csv", "n,name\n2,새\n")
    put(f"{base}/request_date=240612/district=종로구/a.csv", "name,n\n")  # a header alone
    os.makedirs(f"{base}/request_date=240612/district=성동구")  # nothing yet
    put(f"{base}/request_date=240612/notes.csv", "name,n\nbeside,3\n")
    put(f"{base}/_manifest_of_others/x", "x")
    return base


def listed(monkeypatch):
    seen = []
    whole, level = M.list_files, M.child_values
    monkeypatch.setattr(M, "list_files", lambda s, p: seen.append(p) or whole(s, p))
    monkeypatch.setattr(M, "child_values", lambda s, p, c: seen.append(p) or level(s, p, c))
    monkeypatch.setattr(S, "list_files", M.list_files)
    monkeypatch.setattr(S, "child_values", M.child_values)
    return seen


def test_latest_lists_no_history(spark, root, monkeypatch):
    seen = listed(monkeypatch)
    rows = S.read_latest_snapshot(spark, root, "csv").collect()
    assert {(r["name"], r["n"], r["district"], r["request_date"]) for r in rows} == {
        ("새", "2", "강남구", "240612"), ("beside", "3", None, "240612")}
    assert all(p == root or "240612" in p for p in seen)


def test_manifest_is_kept_up_to_date(spark, root, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/manifest"
    first = M.refresh_manifest(spark, root, path)
    assert first.count() == 4 + 4
    assert tuple(M.latest_members(first).first()) == ("240612", ["강남구", "성동구", "종로구"])
    assert M.latest_date(first, name="d").first()["d"] == "240612"
    seen = listed(monkeypatch)
    put(f"{root}/request_date=240612/district=성동구/b.csv", "name,n\n늦은,4\n")  # the newest was still filling
    put(f"{root}/request_date=240701/district=중구/a.csv", "name,n\n칠월,5\n")
    shutil.move(f"{root}/request_date=231231", f"{tmp_dir}/gone")
    again = M.refresh_manifest(spark, root, path)
    assert not any("240105" in p and root in p for p in seen)  # history is not listed again
    assert {r["request_date"] for r in again.collect()} == {"240105", "240612", "240701"}
    assert [os.path.basename(f.path) for f in M.files_of(again, "240612")].count("b.csv") == 1
    assert tuple(M.latest_members(again).first()) == ("240701", ["중구"])
    rows = S.read_snapshot(spark, root, "240612", manifest_path=path).collect()
    assert {r["name"] for r in rows} == {"새", "beside", "늦은"}
    with pytest.raises(ValueError):
        S.read_snapshot(spark, root, "231231")


def test_empty_roots(spark, tmp_dir):
    with pytest.raises(ValueError):
        S.read_latest_snapshot(spark, f"{tmp_dir}/none")
    empty = M.refresh_manifest(spark, f"{tmp_dir}/none", f"{tmp_dir}/m")
    assert empty.count() == 0 and M.latest_members(empty).count() == 0 and M.latest_date(empty).first()[0] is None


def test_members_come_without_a_data_file(spark, root, tmp_dir):
    table = M.latest_members(M.refresh_manifest(spark, root, f"{tmp_dir}/manifest"))
    assert all("/manifest/" in f for f in table.inputFiles())
