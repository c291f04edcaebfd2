"""ledgerline: title labelling, snapshot and restore on Spark.

The main entry points, importable from the package root::

    from ledgerline import TableStore, sync_into, backup_table, reload_table
"""

from ledgerline.operators.labels import (  # noqa: F401
    consolidate_max, derive_label, new_keys_only, set_flag_all, sync_into, sync_media_to_training,
)
from ledgerline.operators.quality import (  # noqa: F401
    apply_defaults, check_violations, key_violations, table_stats,
)
from ledgerline.operators.restore import reload_all, reload_table, round_trip_diff  # noqa: F401
from ledgerline.operators.snapshot import backup_all, backup_table  # noqa: F401
from ledgerline.sources.spec import load_samples, schema_from_spec  # noqa: F401
from ledgerline.sources.store import TableStore  # noqa: F401

__version__ = "0.1.0"
