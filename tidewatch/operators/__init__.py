"""tidewatch.operators"""
