"""Layouts drawn from the tables by SQL that both engines read: hundreds of books, decks and pages of boxes, lines, captions and ink, with nulls,
ties and repeated rows as the tables happen to have them. They stand for decoded layout, which the tables do not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Each may read those before it.
LAYOUTS = {
    "dx_item": """SELECT l_orderkey AS o, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INT) AS pos,
        CAST(l_partkey AS INT) AS p, CAST(l_suppkey AS INT) AS s, CAST(l_quantity AS INT) AS q, l_returnflag AS flag FROM lineitem""",
    # slides: 20 to a deck; some first lines repeat, every other line has a bullet
    "dx_line": """SELECT CAST(floor(o / 20) AS BIGINT) AS deck_id, CAST(o % 20 AS INT) AS page_idx, pos, CAST(40 + (p % 3) * 30 + s % 4 AS DOUBLE) AS x0, CAST(20 + (pos - 1) * 60 + s % 6 AS DOUBLE) AS y0,
        CAST(140 + (p % 3) * 30 + s % 4 + p % 50 AS DOUBLE) AS x1, CAST(30 + (pos - 1) * 60 + s % 6 + (q % 3) * 6 AS DOUBLE) AS y1,
        CASE WHEN pos = 1 AND p % 3 <> 0 THEN 'Course ' || CAST(o % 20 AS STRING) || ' of 20' WHEN q = 50 THEN '' WHEN q % 7 = 0 THEN 'see the course # of 20 next' ELSE 'line ' || flag || ' ' || CAST(p AS STRING) || ' of part' END AS text,
        CASE WHEN q % 2 = 0 THEN CAST(20 + (p % 3) * 30 + s % 4 AS DOUBLE) END AS bullet_x, CAST(50 + q AS DOUBLE) AS confidence, CAST(540 AS DOUBLE) AS height, CAST(300 AS DOUBLE) AS page_width FROM dx_item""",
    # slides as a deck file has them, and rendered pages of most of them
    "dx_slide": """SELECT CAST(floor(o / 20) AS BIGINT) AS deck_id, CAST(o % 20 AS INT) AS slide_no, max(q) > 48 AS hidden, max(CASE WHEN pos = 1 AND q % 3 <> 0 THEN 'Title ' || CAST(p AS STRING) WHEN pos = 1 AND q % 6 = 0 THEN '  ' END) AS title,
        'Title ' || CAST(min(p) AS STRING) AS item FROM dx_item GROUP BY o""",
    "dx_rendered": """SELECT deck_id, slide_no, item AS title FROM dx_slide WHERE deck_id % 3 <> 0 OR NOT hidden""",
    # pages of boxes: some overlap, some are equal
    "dx_box": """SELECT o AS set_id, CAST(pos AS BIGINT) AS box_id, pos, CAST((p % 12) * 8 AS DOUBLE) AS x0, CAST((s % 10) * 8 AS DOUBLE) AS y0, CAST((p % 12) * 8 + 10 + q AS DOUBLE) AS x1, CAST((s % 10) * 8 + 12 + q % 9 AS DOUBLE) AS y1 FROM dx_item""",
    # lines of book pages, of which some are captions or look like them
    "dx_caption_line": """SELECT CAST(floor(o / 10) AS BIGINT) AS doc_id, CAST(o % 10 AS INT) AS page_idx, pos, CAST(50 + p % 5 AS DOUBLE) AS x0, CAST(40 * pos AS DOUBLE) AS y0, CAST(200 AS DOUBLE) AS x1, CAST(40 * pos + 12 AS DOUBLE) AS y1,
        CASE q % 8 WHEN 0 THEN 'Figure ' || CAST(p % 9 + 1 AS STRING) || '.' || CAST(s % 9 + 1 AS STRING) || ' The  flow of ' || flag WHEN 1 THEN 'Table ' || CAST(p % 9 + 1 AS STRING) || '.2 (continued)' WHEN 2 THEN 'Figure ' || CAST(p % 9 + 1 AS STRING) || '.3, which shows' WHEN 3 THEN 'Table A.1 shows it'
          WHEN 4 THEN 'as seen in Figure ' || CAST(p % 9 + 1 AS STRING) || '.' || CAST(s % 9 + 1 AS STRING) || ' and Table ' || CAST(p % 4 + 1 AS STRING) || '.2' WHEN 5 THEN 'It ends.' WHEN 6 THEN 'fig. ' || CAST(p % 9 + 1 AS STRING) || '.7.1 Deep' ELSE 'goes on' END AS text FROM dx_item""",
    # dark cells of page images, and a figure on each page
    "dx_ink": """SELECT o AS page_idx, p % 70 AS gx, s % 60 AS gy FROM dx_item UNION ALL SELECT o, p % 70 + 1, s % 60 FROM dx_item UNION ALL SELECT o, p % 70, s % 60 + 2 FROM dx_item""",
    "dx_figure": """SELECT o AS page_idx, '1.' || CAST(min(q) % 3 AS STRING) AS no, CAST(min(p) % 30 AS DOUBLE) AS x0, CAST(min(s) % 30 AS DOUBLE) AS y0, CAST(min(p) % 30 + 60 AS DOUBLE) AS x1, CAST(min(s) % 30 + 80 AS DOUBLE) AS y1 FROM dx_item GROUP BY o""",
    # chunks of three pages and their answers: some lack a page, some have one too many
    "dx_answer": """SELECT o AS chunk_no, 'Head' || chr(10) || '<!-- page ' || CAST(o % 7 AS STRING) || ' -->one' || chr(10) || '<!-- page ' || CAST(o % 7 + 1 AS STRING) || ' -->two <!-- page ' || CAST(o % 7 + 2 AS STRING) || ' -->three' AS source_text,
        '# page ' || CAST(o % 7 AS STRING) || chr(10) || 'a' || chr(10) || '# The page  ' || CAST(o % 7 + 1 + min(q) % 3 AS STRING) || chr(10) || '## page 99' || chr(10) || '# no number' || chr(10) || '# page ' || CAST(o % 7 + 2 AS STRING) AS answer_text FROM dx_item GROUP BY o""",
    "dx_reading": """SELECT CAST(floor(o / 4) AS BIGINT) AS page_idx, CAST(o % 4 AS INT) AS reading, CASE WHEN q % 11 <> 0 THEN CAST(50 + q AS DOUBLE) END AS conf FROM dx_item""",
    "dx_render": """SELECT o AS slide_no, pos AS rank, CAST(q % 5 * 0.0025 AS DOUBLE) AS fill, q, flag FROM dx_item""",
    "dx_file": """SELECT DISTINCT 'f' || CAST(o % 90 AS STRING) || '/' || CASE WHEN q % 17 = 0 THEN '~$' WHEN q % 19 = 0 THEN '.' ELSE '' END || 'deck' || CAST(p % 40 AS STRING) || CASE s % 8 WHEN 0 THEN '.pptx' WHEN 1 THEN '.PDF' WHEN 2 THEN '.ppt' WHEN 3 THEN '.odp' WHEN 4 THEN '.txt' WHEN 5 THEN '.pps' ELSE '.pdf' END AS path FROM dx_item""",
    "dx_numbered": """SELECT o AS doc_id, pos AS page_idx, CASE WHEN q % 9 <> 0 THEN p % 30 + 1 END AS printed_no,
        CASE q % 5 WHEN 0 THEN '**' || CAST(p % 30 + 1 AS STRING) || '** Basics' WHEN 1 THEN 'Basics ' || CAST(p % 30 + 1 AS STRING) WHEN 2 THEN CAST(p % 30 + 1 AS STRING) || '.1 A section' WHEN 3 THEN CAST(p % 30 + 1 AS STRING) || '5 rows' ELSE 'No number' END || chr(10) || chr(10) || 'Text ' || CAST(p % 30 + 1 AS STRING) || chr(10) || 'more' || chr(10) || CAST(s % 4 AS STRING) || chr(10) || CASE WHEN s % 2 = 0 THEN '# ' || CAST(p % 30 + 1 AS STRING) ELSE 'v' || CAST(p % 30 + 1 AS STRING) END AS text FROM dx_item""",
    # stacked lines, with large initials among them
    "dx_stack": """SELECT o AS page_idx, pos, CASE WHEN q % 4 = 0 THEN flag WHEN q % 4 = 1 THEN 'his ' || CAST(p AS STRING) ELSE 'Other ' || CAST(p AS STRING) END AS text, CAST(CASE WHEN q % 4 = 0 THEN 30 ELSE 10 END AS DOUBLE) AS size,
        CAST(CASE WHEN q % 4 = 0 THEN s % 3 ELSE 12 + s % 20 END AS DOUBLE) AS x0, CAST(pos * 14 + q % 3 * 3 AS DOUBLE) AS y0, CAST(CASE WHEN q % 4 = 0 THEN s % 3 + 12 ELSE 60 + p % 30 END AS DOUBLE) AS x1, CAST(pos * 14 + q % 3 * 3 + CASE WHEN q % 4 = 0 THEN 30 ELSE 12 END AS DOUBLE) AS y1 FROM dx_item""",
    # texts in which words are torn by spaces, and words split at a line's end
    "dx_torn": """SELECT CAST(floor(o / 30) AS BIGINT) AS deck_id, o, pos, CASE p % 6 WHEN 0 THEN 'sys tem' WHEN 1 THEN 'haza rd' WHEN 2 THEN 'system' WHEN 3 THEN 'hazard' WHEN 4 THEN 'in to' ELSE 'into' END || ' of ' || CASE WHEN s % 47 = 0 THEN 'haza' WHEN s % 43 = 0 THEN 'tem' WHEN s % 5 = 0 THEN 'in' ELSE 'plants' END AS text FROM dx_item""",
    "dx_hyphen": """SELECT CAST(floor(o / 50) AS BIGINT) AS doc_id, CASE p % 6 WHEN 0 THEN 'real' WHEN 1 THEN 'time' WHEN 2 THEN 'so' WHEN 3 THEN 'Addison' WHEN 4 THEN 'life' ELSE 'develop' END AS a, CASE s % 6 WHEN 0 THEN 'time' WHEN 1 THEN 'based' WHEN 2 THEN 'Wesley' WHEN 3 THEN 'ment' WHEN 4 THEN 'called' ELSE 'Front' END AS b,
        CASE q % 5 WHEN 0 THEN 'develop' WHEN 1 THEN 'Real' WHEN 2 THEN 'life' ELSE 'up' END AS c, CASE q % 3 WHEN 0 THEN 'ment' WHEN 1 THEN 'front' ELSE 'Time' END AS d FROM dx_item""",
    # spans of book pages, pages with printed numbers, contents with chapters, parts and ends
    "dx_span": """SELECT CAST(floor(o / 10) AS BIGINT) AS doc_id, CAST(o % 10 AS INT) AS page_idx, pos AS block_no, 0 AS line_no, 0 AS span_no, CASE p % 3 WHEN 0 THEN 'Arial' ELSE 'Times' END AS font, CAST(9 + q % 5 * 0.5 AS DOUBLE) AS size, CASE WHEN q % 13 = 0 THEN '  ' ELSE ' some text ' || flag || CAST(p AS STRING) END AS text FROM dx_item""",
    "dx_page": """SELECT CAST(floor(o / 10) AS BIGINT) AS doc_id, CAST(o % 10 AS INT) AS page_idx, CASE q % 5 WHEN 0 THEN CAST(o % 10 + 3 AS STRING) || ' Basics' WHEN 1 THEN 'Basics ' || CAST(o % 10 + 3 AS STRING) WHEN 2 THEN 'No number' WHEN 3 THEN CAST(p AS STRING) ELSE CAST(o % 10 + 3 AS STRING) END || chr(10) || 'Some text.' || chr(10)
        || CASE WHEN s % 4 = 0 THEN '' ELSE 'More ' || flag || chr(10) || 'and 7 more' || chr(10) END || CASE WHEN s % 3 = 0 THEN CAST(o % 10 + 3 AS STRING) ELSE 'end' END AS text FROM dx_item WHERE pos = 1""",
    "dx_toc_entry": """SELECT CAST(floor(o / 8) AS BIGINT) AS doc_id, CAST(o % 8 + 1 AS INT) AS pos, CASE WHEN o % 8 = 7 THEN CASE q % 3 WHEN 0 THEN 'glossary' WHEN 1 THEN 'end' ELSE 'appendix' END WHEN q % 4 = 0 THEN 'part' ELSE 'chapter' END AS kind,
        CASE WHEN o % 8 = 7 THEN CASE WHEN q % 3 = 2 THEN 'A' ELSE '' END WHEN q % 4 = 0 THEN '' ELSE CAST(p % 6 + 1 AS STRING) END AS no, 'Title ' || CAST(s AS STRING) AS title, CAST(o % 8 * 6 + q % 5 + 1 AS INT) AS printed_page FROM dx_item WHERE pos = 1""",
    "dx_offset": """SELECT doc_id, CAST(doc_id % 5 AS INT) AS page_offset FROM dx_toc_entry GROUP BY doc_id""",
    "dx_document": """SELECT doc_id, CAST(44 + doc_id % 20 AS INT) AS n_pages FROM dx_toc_entry GROUP BY doc_id""",
    # clusters of drawn objects and captions near them
    "dx_cluster": """SELECT o AS page_idx, CAST(pos AS BIGINT) AS cluster, CAST(p % 6 * 50 AS DOUBLE) AS x0, CAST(s % 10 * 40 AS DOUBLE) AS y0, CAST(p % 6 * 50 + 30 + q AS DOUBLE) AS x1, CAST(s % 10 * 40 + 30 + q % 20 AS DOUBLE) AS y1 FROM dx_item""",
    "dx_caption": """SELECT o AS page_idx, '1.' || CAST(pos AS STRING) AS no, CASE WHEN q % 3 = 0 THEN 'table' ELSE 'figure' END AS kind, CAST(q % 6 * 50 AS DOUBLE) AS x0, CAST(p % 10 * 40 + 33 AS DOUBLE) AS y0, CAST(q % 6 * 50 + 100 AS DOUBLE) AS x1, CAST(p % 10 * 40 + 45 AS DOUBLE) AS y1 FROM dx_item WHERE pos % 2 = 1""",
    # words over the cells of a table of up to three rows
    "dx_word": """SELECT CAST(floor(o / 8) AS INT) AS page_idx, CAST(o % 8 * 100 + pos AS INT) AS pos, CAST(p % 190 AS DOUBLE) AS x0, CAST((p * 7 + q) % 50 AS DOUBLE) AS y0, CAST(p % 190 + 10 AS DOUBLE) AS x1, CAST((p * 7 + q) % 50 + 8 AS DOUBLE) AS y1, CASE q % 6 WHEN 0 THEN 'off-' WHEN 1 THEN 'a|b' WHEN 2 THEN 'two words' ELSE 'word' || CAST(p AS STRING) END AS text, CAST(60 + q % 40 AS DOUBLE) AS conf FROM dx_item""",
    "dx_cell": """SELECT CAST(floor(o / 8) AS INT) AS page_idx, 1 AS table_id, CAST(floor((pos - 1) / 2) AS INT) AS row_no, CAST((pos - 1) % 2 AS INT) AS col_no, CAST((pos - 1) % 2 * 100 AS DOUBLE) AS x0, CAST(floor((pos - 1) / 2) * 20 AS DOUBLE) AS y0, CAST((pos - 1) % 2 * 100 + 100 AS DOUBLE) AS x1, CAST(floor((pos - 1) / 2) * 20 + 20 AS DOUBLE) AS y1 FROM dx_item WHERE o % 8 = 0 AND pos <= 6""",
    # slides with a table of terms: wrapped meanings, wrapped terms, rows without a term, bullets between
    "dx_grid": """SELECT o AS page_idx, pos * 10 + 1 AS pos, CAST(40 + s % 4 AS DOUBLE) AS x0, CAST(pos * 30 + s % 2 AS DOUBLE) AS y0, CAST(90 AS DOUBLE) AS x1, CAST(pos * 30 + s % 2 + 10 AS DOUBLE) AS y1, 'term ' || CAST(p AS STRING) AS text, CAST(NULL AS DOUBLE) AS bullet_x FROM dx_item WHERE q % 6 <> 0
        UNION ALL SELECT o, pos * 10 + 2, CAST(200 + p % 5 AS DOUBLE), CAST(pos * 30 AS DOUBLE), CAST(260 AS DOUBLE), CAST(pos * 30 + 10 AS DOUBLE), 'meaning ' || CAST(s AS STRING) || CASE WHEN q % 8 = 0 THEN '-' ELSE '' END, NULL FROM dx_item
        UNION ALL SELECT o, pos * 10 + 3, CAST(200 + p % 5 AS DOUBLE), CAST(pos * 30 + 12 AS DOUBLE), CAST(250 AS DOUBLE), CAST(pos * 30 + 22 AS DOUBLE), 'wrapped ' || flag, NULL FROM dx_item WHERE q % 4 = 0
        UNION ALL SELECT o, pos * 10 + 4, CAST(41 AS DOUBLE), CAST(pos * 30 + 12 AS DOUBLE), CAST(80 AS DOUBLE), CAST(pos * 30 + 22 AS DOUBLE), 'longer', NULL FROM dx_item WHERE q % 9 = 0
        UNION ALL SELECT o, pos * 10 + 5, CAST(60 AS DOUBLE), CAST(pos * 30 + 20 AS DOUBLE), CAST(120 AS DOUBLE), CAST(pos * 30 + 30 AS DOUBLE), 'item', CAST(50 AS DOUBLE) FROM dx_item WHERE q % 11 = 0""",
    # slides of decks: tables of terms on every third, else lines; titles of one or two lines, lines that go on; rasters and drawings
    "dx_deck_line": """SELECT CAST(floor(page_idx / 20) AS BIGINT) AS deck_id, page_idx, pos, x0, y0 + 40 AS y0, x1, y1 + 40 AS y1, text, bullet_x FROM dx_grid WHERE page_idx % 3 = 0
        UNION ALL SELECT deck_id, deck_id * 20 + page_idx, pos * 10, x0, y0 + 40, x1, y1 + 40, text, bullet_x FROM dx_line WHERE (deck_id * 20 + page_idx) % 3 <> 0
        UNION ALL SELECT deck_id, deck_id * 20 + page_idx, pos * 10 + 4, x0 + pos * 3 - 8, y1 + 40 + pos * 3 - 6, x1, y1 + 52 + pos * 3 - 6, 'goes on-', NULL FROM dx_line WHERE (deck_id * 20 + page_idx) % 3 <> 0 AND confidence % 3 = 0
        UNION ALL SELECT CAST(floor(o / 20) AS BIGINT), o, 9, CAST(30 AS DOUBLE), CAST(s % 3 AS DOUBLE), CAST(200 AS DOUBLE), CAST(s % 3 + 8 + q % 4 * 6 AS DOUBLE), 'Title ' || CAST(p AS STRING), NULL FROM dx_item WHERE pos = 1 AND q % 7 <> 0
        UNION ALL SELECT CAST(floor(o / 20) AS BIGINT), o, 8, CAST(30 AS DOUBLE), CAST(s % 3 + 30 AS DOUBLE), CAST(200 AS DOUBLE), CAST(s % 3 + 38 + q % 4 * 6 AS DOUBLE), 'and ' || flag, NULL FROM dx_item WHERE pos = 1 AND q % 5 = 0""",
    "dx_deck_area": """SELECT CAST(floor(o / 20) AS BIGINT) AS deck_id, o AS page_idx, CASE q % 5 WHEN 0 THEN 'raster' WHEN 1 THEN 'line' ELSE 'shape' END AS kind, CAST(p % 150 AS DOUBLE) AS x0, CAST(60 + p % 90 AS DOUBLE) AS y0, CAST(p % 150 + q AS DOUBLE) AS x1, CAST(80 + p % 90 + q AS DOUBLE) AS y1 FROM dx_item WHERE o % 4 <> 1""",
    # lines of image slides: course footers, some of them misread or small
    "dx_foot": """SELECT CAST(floor(o / 20) AS BIGINT) AS deck_id, CAST(o % 20 AS INT) AS page_idx, pos, CASE WHEN pos = 1 AND q % 5 = 0 THEN 'C0urse of Systoms' WHEN pos = 1 AND q % 5 = 1 THEN 'Course of Systems and more' WHEN pos = 1 THEN 'Course of Systems ' || CAST(q AS STRING) WHEN pos = 2 THEN 'Lecturer Nane ' || flag WHEN pos = 3 THEN 'page' ELSE 'line of text ' || flag END AS text,
        CAST(pos * 40 AS DOUBLE) AS y0, CAST(pos * 40 + CASE WHEN pos <= 2 AND s % 3 <> 0 THEN 8 ELSE 16 END AS DOUBLE) AS y1 FROM dx_item""",
    # small figures on a page's ink, two at most
    "dx_part": """SELECT o AS page_idx, 'f' || CAST(pos AS STRING) AS no, CAST(p % 70 * 2 AS DOUBLE) AS x0, CAST(s % 60 * 2 AS DOUBLE) AS y0, CAST(p % 70 * 2 + 3 AS DOUBLE) AS x1, CAST(s % 60 * 2 + 3 AS DOUBLE) AS y1 FROM dx_item WHERE pos <= 2""",
    # scanned pages, a manifest, the files it tells of and what was made of them
    "dx_scan": """SELECT CAST(floor(o / 10) AS BIGINT) AS doc_id, CAST(o % 10 AS INT) AS page_idx, CASE WHEN floor(o / 10) % 3 = 0 AND q % 3 = 0 THEN 'a text that is much longer than that' WHEN q % 4 = 0 THEN NULL ELSE 'short ' || flag END AS text, q % 17 <> 0 AS has_image FROM dx_item WHERE pos = 1""",
    "dx_source": """SELECT 'f' || CAST(o % 90 AS STRING) || '/d' || CAST(p % 20 AS STRING) || '.pdf' AS path, 'h' || CAST(min(q) % 3 AS STRING) AS sha1, CAST(max(s) % 10 AS INT) AS modified FROM dx_item WHERE flag <> 'R' GROUP BY 1""",
    "dx_manifest": """SELECT 'f' || CAST(o % 90 AS STRING) || '/d' || CAST(p % 20 AS STRING) || '.pdf' AS path, CASE WHEN max(p) % 4 = 0 THEN '1' ELSE '2' END AS version, 'h' || CAST(max(q) % 3 AS STRING) AS sha1 FROM dx_item WHERE flag <> 'A' GROUP BY 1""",
    "dx_output": """SELECT 'f' || CAST(o % 90 AS STRING) || '/d' || CAST(p % 20 AS STRING) || '.pdf' AS path, CAST(min(s) % 10 AS INT) AS modified FROM dx_item WHERE q % 3 <> 0 GROUP BY 1""",
    # paragraphs of chapters, items with a glyph read as I
    "dx_paragraph": """SELECT CAST(floor(o / 20) AS BIGINT) AS doc_id, CAST(o % 20 * 100 + pos AS INT) AS pos, CASE q % 13 WHEN 0 THEN '# Chapter one' WHEN 1 THEN 'In most places there are now fewer natural' WHEN 2 THEN '| a | b |' WHEN 3 THEN '###### History of it' WHEN 4 THEN 'A box with its own end.' WHEN 5 THEN 'resources, and they change.' WHEN 6 THEN 'https://example.com/a'
        WHEN 7 THEN 'Figure 2.1 A caption' WHEN 8 THEN 'of testing' WHEN 9 THEN '- an item of the list' WHEN 10 THEN '![x](y.png)' WHEN 11 THEN 'cell <br> cell' ELSE 'Whole ' || flag END AS text FROM dx_item""",
    "dx_bullet": """SELECT CAST(floor(o / 5) AS BIGINT) AS doc_id, CAST(o % 5 * 100 + pos AS INT) AS pos, CASE q % 5 WHEN 0 THEN '' WHEN 1 THEN '- plain ' || flag WHEN 2 THEN 'Text.' ELSE '- I item ' || flag END AS text FROM dx_item""",
    # blocks of two fonts, and rules with notes under them
    "dx_block_span": """SELECT o AS page_idx, CAST(pos % 2 AS INT) AS block_no, pos AS line_no, CASE WHEN q % 3 = 0 THEN 'Times' ELSE 'Italic' END AS font, CAST(9.5 + q % 3 AS DOUBLE) AS size, 'words ' || CASE WHEN s % 2 = 0 THEN 'that are many more here' ELSE flag END AS text, CAST(50 AS DOUBLE) AS x0, CAST(pos * 12 AS DOUBLE) AS y0, CAST(250 + p % 200 AS DOUBLE) AS x1, CAST(pos * 12 + 10 AS DOUBLE) AS y1 FROM dx_item""",
    "dx_rule": """SELECT o AS page_idx, CAST(48 + p % 8 AS DOUBLE) AS x0, CAST(480 + p * 3 % 200 AS DOUBLE) AS y0, CAST(60 + p % 300 AS DOUBLE) AS x1, CAST(480.5 + p * 3 % 200 + q % 3 AS DOUBLE) AS y1 FROM dx_item""",
    "dx_note": """SELECT o AS page_idx, CAST(7 + q % 4 AS DOUBLE) AS size, CASE WHEN q % 5 = 0 THEN 'See it' ELSE CAST(q AS STRING) || ' See the source' END AS text, CAST(50 AS DOUBLE) AS x0, CAST(485 + p * 3 % 200 + s % 20 AS DOUBLE) AS y0, CAST(300 AS DOUBLE) AS x1, CAST(495 + p * 3 % 200 + s % 20 AS DOUBLE) AS y1 FROM dx_item""",
    # book pages of body text, captions with a second line, labels and drawings above the captions; frames, rules and white fills among them; their ink
    "dx_figure_span": """SELECT o AS page_idx, pos AS block_no, 0 AS line_no, CASE WHEN pos % 3 = 1 THEN 'Times' ELSE 'Arial' END AS font, CAST(CASE WHEN pos % 3 = 1 THEN 10 ELSE 8 END AS DOUBLE) AS size, CASE pos % 3 WHEN 1 THEN 'Body text that explains it in detail ' || flag WHEN 2 THEN 'Figure 1.' || CAST(pos AS STRING) || ' A picture of ' || flag ELSE 'label ' || CAST(p AS STRING) END AS text,
        CAST(60 + CASE WHEN pos % 3 = 0 THEN 40 + p % 80 ELSE 0 END AS DOUBLE) AS x0, CAST(60 + pos * 95 + CASE WHEN pos % 3 = 2 THEN 70 ELSE 0 END AS DOUBLE) AS y0, CAST(CASE pos % 3 WHEN 1 THEN 500 WHEN 2 THEN 220 ELSE 160 + p % 80 END AS DOUBLE) AS x1, CAST(70 + pos * 95 + CASE WHEN pos % 3 = 2 THEN 70 ELSE 0 END AS DOUBLE) AS y1 FROM dx_item
        UNION ALL SELECT o, pos, 1, CASE WHEN pos % 3 = 1 THEN 'Times' ELSE 'Arial' END, CAST(CASE WHEN pos % 3 = 1 THEN 10 ELSE 8 END AS DOUBLE), 'and its second line', 62, CAST(72 + pos * 95 + CASE WHEN pos % 3 = 2 THEN 70 ELSE 0 END AS DOUBLE), CAST(CASE WHEN pos % 3 = 1 THEN 480 ELSE 180 END AS DOUBLE), CAST(82 + pos * 95 + CASE WHEN pos % 3 = 2 THEN 70 ELSE 0 END AS DOUBLE) FROM dx_item WHERE pos % 3 <> 0 AND q % 4 = 0""",
    "dx_figure_drawing": """SELECT o AS page_idx, CASE WHEN q % 5 = 0 THEN 'image' ELSE 'drawing' END AS kind, CAST(CASE WHEN q % 7 = 0 THEN 1 ELSE 0.5 END AS DOUBLE) AS fill, CAST(60 + p % 40 AS DOUBLE) AS x0, CAST(60 + pos * 95 AS DOUBLE) AS y0, CAST(160 + p % 40 AS DOUBLE) AS x1, CAST(122 + pos * 95 AS DOUBLE) AS y1 FROM dx_item WHERE pos % 3 = 2
        UNION ALL SELECT o, 'drawing', CAST(0 AS DOUBLE), CAST(180 + p % 40 AS DOUBLE), CAST(65 + pos * 95 AS DOUBLE), CAST(230 + p % 40 AS DOUBLE), CAST(100 + pos * 95 AS DOUBLE) FROM dx_item WHERE pos % 3 = 2 AND q % 2 = 0
        UNION ALL SELECT o, 'drawing', CAST(NULL AS DOUBLE), CAST(20 AS DOUBLE), CAST(20 AS DOUBLE), CAST(575 AS DOUBLE), CAST(CASE WHEN q % 2 = 0 THEN 820 ELSE 20.5 END AS DOUBLE) FROM dx_item WHERE pos = 1""",
    "dx_figure_ink": """SELECT o AS page_idx, CAST(30 + (p % 40 + k * 7) / 2 AS INT) AS gx, CAST(35 + pos * 95 / 2 + k % 3 AS INT) AS gy FROM dx_item CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 16 UNION ALL SELECT 17) c WHERE pos % 3 = 2""",
    # bullets beside the lines of slides
    "dx_mark": """SELECT CAST(floor(o / 20) AS BIGINT) AS deck_id, CAST(o % 20 AS INT) AS page_idx, pos AS mark, CAST(30 + (p % 3) * 30 - q % 60 AS DOUBLE) AS x, CAST(25 + (pos - 1) * 60 + s % 6 + q % 19 - 9 AS DOUBLE) AS yc FROM dx_item""",
    # headings of a kind, in words of odd case
    "dx_odd": """SELECT o, pos, CASE q % 6 WHEN 0 THEN 'exerCiSeS of the day' WHEN 1 THEN 'Plain WORDS here' WHEN 2 THEN 'sYstem' || CAST(p AS STRING) || ' aBc' WHEN 3 THEN 'McDonald and eBay' WHEN 4 THEN 'oNe TwO ThReE fouR' ELSE 'iPhone' END AS text FROM dx_item""",
}


def _chain(names: tuple[str, ...]) -> str:
    wanted, todo = set(names), list(names)
    while todo:
        sql = LAYOUTS[todo.pop()]
        for other in LAYOUTS:
            if f"FROM {other}" in sql and other not in wanted:
                wanted.add(other)
                todo.append(other)
    return ", ".join(f"{n} AS ({sql})" for n, sql in LAYOUTS.items() if n in wanted)


def cte(*names: str) -> str:
    """The layouts as expressions to stand behind WITH."""
    return _chain(names)


def frame(spark: SparkSession, sf: str, name: str, lineitem: DataFrame | None = None) -> DataFrame:
    """A layout over the tables in sf, or over some of the rows of lineitem."""
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet") if lineitem is None else lineitem
    return spark.sql(f"WITH {_chain((name,))} SELECT * FROM {name}".replace("FROM lineitem", "FROM {lineitem}"), lineitem=lineitem)
