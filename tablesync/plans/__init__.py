from tablesync.plans.publish import TableStore, VerificationError

__all__ = ["TableStore", "VerificationError"]
