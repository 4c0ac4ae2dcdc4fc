"""Operators: functions from DataFrame to DataFrame, no action unless stated."""
