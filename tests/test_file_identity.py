"""Files of equal names in different folders are different files."""

from shelfmark.sources import files


def test_encodings_are_told_per_path(spark, tmp_path):
    for folder, encoding in (("a", "utf-8"), ("b", "latin-1")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_bytes("name\ncafé\n".encode(encoding))
    rows = files.read_csv_any_encoding(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], ["name"]).collect()
    assert [r["name"] for r in rows] == ["café", "café"]
    assert {r["source_file"] for r in rows} == {"x.csv"}
