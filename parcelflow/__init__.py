"""Device and application message streams as Spark jobs.

``sources`` read messages and rule tables, ``operators`` turn messages into
envelopes, rules into requests and search nested payloads, ``sinks`` archive,
publish and deliver, ``streaming`` runs the same functions per micro-batch,
and ``plans`` assembles them into whole jobs.
"""
