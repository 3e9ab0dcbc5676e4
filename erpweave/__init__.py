"""erpweave: unify ERP table extracts from several systems on Spark.

The library is a set of ``DataFrame -> DataFrame`` operators (``operators``), reusable
``Column`` expressions (``functions``), readers, writers and fixture sources
(``sources``), the two end-to-end data sets (``plans``) and a micro-batch adapter
(``streaming``). All of these are built from built-in DataFrame operations so Catalyst
plans and codegens the whole job. ``llm`` holds operators for training data; it is optional
and not imported from here.
"""

from erpweave import contracts
from erpweave.session import apply_recommended_conf, clear_scratch, recommended_conf, work_dir

__all__ = ["apply_recommended_conf", "clear_scratch", "contracts", "recommended_conf", "work_dir"]
