"""txnguard: payment-transaction cleaning, scoring and monitoring on Spark."""
