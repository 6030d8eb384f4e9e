"""tidewatch.streaming"""
