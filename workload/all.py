"""Importing this module fills the registry."""

import workload.search  # noqa: F401
import workload.encodings  # noqa: F401
import workload.hybrid  # noqa: F401
import workload.predicates  # noqa: F401
import workload.tables  # noqa: F401
import workload.ann  # noqa: F401
