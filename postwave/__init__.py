"""postwave: PySpark analytics over streams and tables of short social posts.

Layers, from small to large:

* ``functions``  Column -> Column expressions (text, tokens, sentiment, vectors)
* ``operators``  DataFrame -> DataFrame steps (filters, trending, corpus, features, model, evaluation)
* ``sources``    readers, stream readers and adapters that produce the post schema
* ``plans``      whole queries built from the operators, and their SQL counterparts
* ``streaming``  the same plans driven by Structured Streaming
"""
