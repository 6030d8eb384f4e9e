"""tidewatch.functions"""
