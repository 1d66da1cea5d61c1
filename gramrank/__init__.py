"""gramrank: text, graph and point analytics as PySpark DataFrame operators.

``sources``    readers, line parsers and sinks
``functions``  column expressions (cleaning, postal codes, distances)
``operators``  single-step DataFrame operators (counts, profiles, joins, draws)
``plans``      multi-step pipelines (TF-IDF, summaries, page ranks, clusters)
"""
