"""tidewatch.sources"""
