"""Text, record and event-stream jobs written as DataFrame-to-DataFrame functions.

Every transform takes a DataFrame and returns one, so the same function serves
``spark.read`` and ``spark.readStream``; sources and sinks sit at the edges.
"""
