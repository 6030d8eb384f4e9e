"""tidewatch.plans"""
