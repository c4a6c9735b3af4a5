"""Ticket files of the catalogue: compressed, and bounded in lines as they cannot be split."""

from basketry.plans import catalog, fixtures
from basketry.sources.readers import read_tickets


def test_ticket_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_LINES", 500)
    tickets = fixtures.tickets(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "tickets")
    catalog._write_tickets(tickets, path)
    files = [f.name for f in (tmp_path / "tickets").iterdir() if f.name.startswith("part-")]
    lines = tickets.count()
    assert all(name.endswith(".json.gz") for name in files) and len(files) >= lines / 500
    assert read_tickets(spark, path).count() == lines
