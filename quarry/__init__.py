"""quarry: question-to-SQL corpus work (profiling, schema text, corpus
preparation, reply cleaning and result scoring) expressed as Spark jobs."""

__version__ = "0.1.0"
