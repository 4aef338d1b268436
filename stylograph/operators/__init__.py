"""Dataset operators: functions from DataFrame to DataFrame."""
