"""Serial-fiction capture analytics as Spark jobs.

Landed web responses (catalog pages, book and chapter JSON, page HTML) go in;
normalized books, chapters, people, images and clean text come out.  Every job
is a DataFrame -> DataFrame function, so Catalyst plans the whole of it.
"""
