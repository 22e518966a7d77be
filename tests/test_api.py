"""A small library from files to reports, by the command line."""

import json

from quirespark import api, cli


def test_library_from_files_to_reports(spark, tmp_path, capsys):
    src, lib = tmp_path / "in", str(tmp_path / "lib")
    src.mkdir()
    body = "\n".join(f"Sentence {i} of the text, which goes on about rivers and roads for a while." for i in range(60))
    book = "\n\n".join(f"Chapter {k}: The Part Of Number {k}\n\n{body}" for k in range(1, 9))
    (src / "My Book (2nd).txt").write_text(book)
    (src / "plain.txt").write_text(body)
    assert cli.main(["list", lib], spark) == 1
    assert cli.main(["process", str(src), lib, "--max-tokens", "600"], spark) == 0
    assert cli.main(["process", str(src), lib], spark) == 0
    assert capsys.readouterr().out.splitlines()[-1] == "nothing new"
    books = {r.title: r for r in api.completed(spark, lib, "books").collect()}
    assert set(books) == {"My Book", "plain"}
    assert (books["My Book"].method, books["plain"].method) == ("anchors", "fixed")
    chapters = api.completed(spark, lib, "chapters").filter(f"book_id = '{books['My Book'].book_id}'").orderBy("chapter_number").collect()
    assert [c.title for c in chapters] == [f"Chapter {k}: The Part Of Number {k}" for k in range(1, 9)]
    sections = api.completed(spark, lib, "sections").collect()
    assert max(s.token_count for s in sections) <= 660 and any(s.is_partial for s in sections)
    assert cli.main(["quality", lib, "--json"], spark) == 0
    assert {json.loads(x)["title"] for x in capsys.readouterr().out.splitlines()} == {"My Book", "plain"}
    for command in ("audit", "report", "merges", "list"):
        assert cli.main([command, lib], spark) == 0
    assert "## Processing Quality Report" in capsys.readouterr().out
    assert cli.main(["chapters", lib, books["plain"].book_id], spark) == 0
    assert "Section 1" in capsys.readouterr().out
