"""Tables that every operator must take: odd rows, none at all, and columns of clashing names."""

from tidewatch.session import cut_lineage

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, id long, n long, h long, "
          "spans string, score double, ids string, path string, kept string, label int, group long, `at` long")


def table(spark, rows, name="odd"):
    """A written table, in few rows' own order. ``rows``: (doc_id, text)."""
    full = [(i, t, "en", "src", len(t or ""), 7, 7, 7, 7, "x", 0.5, "x", "x", "x", 1, 1, 1) for i, t in rows]
    return cut_lineage(spark.createDataFrame(full, SCHEMA).coalesce(2), name)


LONG = "A rather long text, of many words and lines.\nIt goes on and on; nobody knows why.\n" * 400
ODD = [(1, "One text of a few plain words only."), (2, None), (3, ""), (None, "No number here, but a text."),
       (4, LONG), (5, "x" * 5000), (6, "A twin text that is here two times, row by row."),
       (6, "A twin text that is here two times, row by row."), (7, "  \n \t\n"), (8, "Ünïcödé 漢字 🙂 <|endoftext|> 12345"),
       (9, "word"), (10, LONG)]
