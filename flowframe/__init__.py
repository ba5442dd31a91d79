"""flowframe: message-flow and table-movement operators as Spark DataFrame jobs.

Every operator is a plain function over DataFrames.  Stateful operators
(grouped release, delay) also have Structured Streaming forms in
``flowframe.streaming`` that give the same answer as the batch form.
"""

__version__ = "0.1.0"
