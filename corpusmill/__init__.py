"""corpusmill: curation, audit and export of question-answer corpora on Spark."""
