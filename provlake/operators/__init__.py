"""provlake.operators"""
