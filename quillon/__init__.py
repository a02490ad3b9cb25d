"""Question answering over text tables, written as Spark DataFrame jobs.

Layout
------
``functions``  column expressions: splitting, tagging, counting, answer spans
``operators``  DataFrame -> DataFrame steps: TF-IDF, topics, vectors, scores
``plans``      whole flows: answer a table of questions, prepare a store
``sources``    readers, writers and text reports
``streaming``  a stream of questions against a prepared store
"""
