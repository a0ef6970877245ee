"""DataFrame-in, DataFrame-out operators.

Submodules: ``clean``, ``stats``, ``recommend``, ``similarity`` (and the
NumPy kernel ``topk_kernel`` that Python workers load).  Nothing is imported
eagerly, so a worker unpickling the kernel does not load Spark ML.
"""
