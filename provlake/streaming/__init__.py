"""provlake.streaming"""
