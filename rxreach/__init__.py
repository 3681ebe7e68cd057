"""rxreach: omni-channel promotion and prescribing analytics on Spark DataFrames."""
