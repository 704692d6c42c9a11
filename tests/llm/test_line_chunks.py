from opsward.llm import line_chunks


def test_chunks_are_compared_by_digest(spark):
    """No text of a chunk is shuffled to find the repeated ones."""
    line = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a\n{line}\nb"), (2, f"c\n{line}"), (2, f"c\n{line}"), (None, None)], "doc_id long, text string")
    assert line_chunks.occurrences(line_chunks.chunked(docs)).columns == ["doc_id", "digest", "first", "sha"]
    got = {r.doc_id: r for r in line_chunks.dedupe_lines(docs).collect()}
    assert got[1].removed_chunks == 0 and got[2].text == "c" and got[2].removed_lines == 1 and got[None].text == ""
