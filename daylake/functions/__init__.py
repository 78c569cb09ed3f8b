from daylake.functions.clock import local_day, run_day, run_second
from daylake.functions.privacy import hash_columns, mask_linear, salted_hash

__all__ = ["hash_columns", "local_day", "mask_linear", "run_day", "run_second", "salted_hash"]
