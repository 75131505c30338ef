import json

from conftest import transaction

from paylens.streaming.ingest import Arrivals, ingest, latest_records, loaded_rows, quarantined, records


def test_each_file_is_ingested_once_across_restarts(spark, tmp_path):
    folder = tmp_path / "in" / "sub"
    folder.mkdir(parents=True)

    def run():
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        return records(spark, str(tmp_path / "t"))

    (folder / "a.json").write_text("\n\n".join(json.dumps(transaction(n)) for n in (1, 2)))
    (folder / "ignored.csv").write_text("x")
    assert loaded_rows(run()).first()[0] == 2
    assert loaded_rows(run()).first()[0] == 2
    (folder / "b.json").write_text(json.dumps(transaction(3)) + "\n")
    table = run()
    assert loaded_rows(table).first()[0] == 3
    assert latest_records(table, limit=1).first()["transaction_id"] == "TXN_00000003"

    (folder / "c.json").write_text("{broken\n")
    (folder / "d.json").write_text(json.dumps(transaction(4)) + "\n")
    assert loaded_rows(run()).first()[0] == 4
    assert [(r.bad_line, r.problem) for r in quarantined(spark, str(tmp_path / "t")).collect()] == [
        ("{broken", "Line is not valid JSON.")]


def test_a_backlog_is_taken_in_steps_and_archived(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    arrivals = Arrivals(files_per_trigger=2, archive=str(tmp_path / "archive"))

    def run():
        ingest(spark, str(folder), str(tmp_path / "t"), str(tmp_path / "c"), arrivals=arrivals).awaitTermination()
        return records(spark, str(tmp_path / "t"))

    for n in range(1, 6):
        (folder / f"{n}.json").write_text(json.dumps(transaction(n)) + "\n")
    table = run()
    assert loaded_rows(table).first()[0] == 5
    # One trigger takes two files, so the five files have at least three load times.
    assert table.select("loaded_at").distinct().count() >= 3
    assert {r.source_file.rsplit("/", 1)[1] for r in table.collect()} == {f"{n}.json" for n in range(1, 6)}
    (folder / "6.json").write_text(json.dumps(transaction(6)) + "\n\u00a0\n" + '{"a": NaN}\n{broken\n')
    assert loaded_rows(run()).first()[0] == 7
    assert [r.bad_line for r in quarantined(spark, str(tmp_path / "t")).collect()] == ["{broken"]
    assert loaded_rows(run()).first()[0] == 7
    # The source moves the files of a batch once the next one has begun.
    archived = {p.name for p in (tmp_path / "archive").rglob("*.json")}
    assert archived and archived.isdisjoint(p.name for p in folder.glob("*.json"))
    assert latest_records(run(), limit=1).columns == ["transaction_id", "loaded_at"]


def test_the_newest_records_are_those_of_the_whole_table(spark, tmp_path):
    def run(numbers, loaded_at):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{numbers[0]}.json").write_text("\n".join(json.dumps(transaction(n)) for n in numbers))
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"),
               loaded_at=loaded_at).awaitTermination()
        return records(spark, str(tmp_path / "t"))

    run([1, 2, 3], "2026-01-02 03:04:05")
    newest = latest_records(run([9, 8], "2026-02-03 04:05:06"), limit=3).collect()
    assert [(r.transaction_id, str(r.loaded_at)) for r in newest] == [
        ("TXN_00000008", "2026-02-03 04:05:06"), ("TXN_00000009", "2026-02-03 04:05:06"),
        ("TXN_00000001", "2026-01-02 03:04:05")]
