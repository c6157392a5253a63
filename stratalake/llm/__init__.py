"""Training-data operators: independent modules over documents, pages and benchmarks.

Nothing else in the library imports this package. Functions that run inside tasks are shipped with
the task, so executors need numpy, pandas and pyarrow but not this package.
"""

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
