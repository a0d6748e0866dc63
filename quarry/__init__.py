"""quarry: batch text and vector retrieval and ranking evaluation on Spark.

Layout:
  functions/  column expressions (tokenizer, BM25, quantiser, vector math)
  sources/    readers and writers (tables, TSV, judgments, runs, vectors)
  operators/  index build, keyword search, kNN, ANN, rerank, metrics, filters
  plans/      retrieval systems end to end, derived judgments, the query catalog
"""
