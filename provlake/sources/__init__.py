"""provlake.sources"""
